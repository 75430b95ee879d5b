from pathlib import Path

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from starloom.llm.queries import ORACLES, QUERIES
from starloom.sources import shared_folder
from tests.llm.edge_rows import DOCS_SCHEMA, edge_docs, sentence, stored
from tests.llm.test_suffix import brute


def documents(spark):
    passage = " ".join(f"shared{i}" for i in range(60))
    lines = "\n".join(f"line {i} of the licence" for i in range(5))
    rows = [(100 + i, sentence(i, 60)) for i in range(12)]
    rows += [(200, sentence(3, 60)), (201, sentence(3, 60) + "\n"), (300, sentence(20, 50) + " " + passage), (301, sentence(21, 50) + " " + passage)]
    rows += [(400, "head\n" + lines + "\nfoot"), (401, lines)]
    return spark.createDataFrame([(i, t, "en", "s", len(t), 7, "f", 1) for i, t in rows], DOCS_SCHEMA).union(edge_docs(spark))


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "suffix_dedup", "packing"]
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    base = str(tmp_path / "sf")
    docs = stored(documents(spark).drop("key", "fp", "__other"), f"{base}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept[-1], base)
        assert out.columns == list(corpus_pipeline.COLUMNS)
        kept.append(stored(out, f"{base}/{name}"))
    scored, lined, single, cut = kept[1:]
    assert scored.count() == docs.count() == lined.count()
    assert {r.doc_id: r.text for r in lined.where("doc_id >= 400").collect()} == {400: "head\n" + "\n".join(f"line {i} of the licence" for i in range(5)) + "\nfoot", 401: ""}
    ids = [r.doc_id for r in single.collect()]
    # Copies, also under one id, and texts without words (5, 6, 7, a null id, and 401, emptied by line dedup) leave one row each.
    assert 103 in ids and 200 not in ids and 201 not in ids and {300, 301, 5} <= set(ids) and not {6, 7, 401} & set(ids)
    assert ids.count(None) == 1 and ids.count(10) == 2
    before = single.collect()
    expected = sorted((k.decode() for _, k in brute([r.text for r in before], 200)))
    assert sorted(r.text for r in cut.collect()) == expected
    pieces = corpus_pipeline.STAGES[-1][1](spark, cut, base)
    ids = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = sorted(((r.doc_id, len(ids.encode(r.text, add_special_tokens=False).ids) + 1) for r in cut.collect()), key=repr)
    # All stages at once give the same documents, and leave only their result.
    shared = Path(shared_folder(spark).removeprefix("file:")) / "llm"
    left = {p.name for p in shared.glob("*")}
    whole = corpus_pipeline.run(spark, base)
    assert len({p.name for p in shared.glob("*")} - left) == 1
    for found in (pieces, whole):
        assert sorted(((r.doc_id, r.doc_tokens) for r in found.where("start = 0").collect()), key=repr) == expected
        assert found.agg({"length": "sum"}).first()[0] == sum(n for _, n in expected)


def test_toxic_documents_go(spark, tmp_path):
    base = str(tmp_path / "sf")
    rows = [(i, sentence(i % 40, 40) + (" you idiot scum loser" if i % 3 == 0 else ""), "en", "s", 0) for i in range(300)]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), f"{base}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    left = {r.doc_id for r in corpus_pipeline.reject_toxic(spark, docs, base).collect()}
    assert left == {i for i in range(300) if i % 3}


def test_run_on_empty_documents(spark, tmp_path):
    base = str(tmp_path / "sf")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    assert corpus_pipeline.run(spark, base).count() == 0


def test_rows_of_one_doc_id_are_judged_by_their_texts(spark, tmp_path):
    rows = [(1, sentence(1)), (2, sentence(2)), (2, sentence(1) + "\n"), (2, sentence(5)), (3, sentence(5)), (3, sentence(7)), (3, sentence(7))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, stored(docs, f"{tmp_path}/documents"), str(tmp_path)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, sentence(1)), (2, sentence(2)), (2, sentence(5)), (3, sentence(7))])
