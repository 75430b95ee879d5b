from collections import Counter

from starloom.llm.lines import line_dedup
from tests.llm.edge_rows import DOCS_SCHEMA, edge_docs, stored


def brute(rows, width=3):
    """Kept text of each (doc_id, text), windows judged in order of doc_id."""
    seen, out = set(), []
    for doc_id, text in sorted(rows):
        lines = text.split("\n") if text is not None else []
        gone = set()
        for i in range(len(lines) - width + 1):
            window = tuple(lines[i : i + width])
            if "".join(window).strip(" "):
                if window in seen:
                    gone.update(range(i, i + width))
                seen.add(window)
        kept = text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((doc_id, len(lines), sorted(gone), kept))
    return out


def test_matches_brute_force(spark, tmp_path):
    passage = "p one\np two\np three\np four"
    texts = [
        "a\n" + passage + "\nb", "c\n" + passage + "\nd\n" + passage, passage, "x\ny", "x\ny", "\n\n\n\n\n", " \n \n \nz", "r\nr\nr\nr\nr\nr",
        "one\ntwo\nthree", "0\none\ntwo\nthree\n", "", "é\n中\n😀", "é\n中\n😀\nq", "tab\t\n\x0b\n\x85", "tab\t\n\x0b\n\x85",
    ]
    rows = list(enumerate(texts))
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), tmp_path / "d")
    got = sorted(tuple(r) for r in line_dedup(docs).collect())
    assert [(a, b, list(c), d) for a, b, c, d in got] == brute(rows)


def test_edge_rows(spark, tmp_path):
    docs = edge_docs(spark)
    extra = spark.createDataFrame([(20, "l1\nl2\nl3\nl4", "en", "s", 0, 7, "f", 1), (20, "l1\nl2\nl3\nl5", "en", "s", 0, 7, "f", 1), (None, "l1\nl2\nl3", "en", "s", 0, 7, "f", 1)], DOCS_SCHEMA)
    rows = line_dedup(stored(docs.union(extra), tmp_path / "d"), carry=("doc_id", "key", "fp")).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.union(extra).collect())
    # The null id comes first; of equal ids one row keeps what another loses.
    assert {r.kept for r in rows if r.doc_id == 20} == {"l4", "l5"}
    assert {r.kept for r in rows if r.doc_id is None} == {"no id", None, "l1\nl2\nl3"}
    assert line_dedup(spark.createDataFrame([], DOCS_SCHEMA)).count() == 0


def test_windows_of_one_line_see_texts_of_one_line(spark):
    docs = spark.createDataFrame([(1, "one"), (2, "one"), (3, "two\none"), (4, None), (5, "")], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in line_dedup(docs, width=1).collect()}
    assert got == {1: "one", 2: "", 3: "two", 4: None, 5: ""}
