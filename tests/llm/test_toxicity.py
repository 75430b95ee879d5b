import random
import zlib

import pytest

from starloom.llm.toxicity import FEATURES, Features, Lexicon, held_out, toxicity, toxicity_scorer
from tests.llm.edge_rows import DOCS_SCHEMA, edge_docs, sentence

LEXICON = Lexicon({"idiot": 4.0}, {"vilw": 3.0})


def of(text):
    return dict(zip(FEATURES, Features(LEXICON).of(text), strict=True))


def test_features():
    found = of("You IDIOT! What an 1d10t, vilwort. Fine.")
    assert found["hits"] == 2 and found["prefix_hits"] == 1 and found["hidden_words"] > 0 and found["hidden_hits"] > 0
    assert found["near_second_person"] > 0 and found["capitals"] > 0.1 and found["marks"] > 0
    assert of("idiot " + "a " * 50 + "you")["near_second_person"] == 0
    assert set(of("").values()) == {0.0}
    assert of("x" * 100_000)["hits"] == 0


def test_held_out_is_the_remainder_one(spark):
    rows = spark.range(200)
    got = {r.id: r.h for r in rows.select("id", held_out(rows["id"]).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(200)}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        words = sentence(i % 50, 30 + i % 20).split()
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "vilwort", "vilwese"]))
        rows.append((i, " ".join(words), "en", "s", 0, 7, "f", 1))
        labels.append((i, int(toxic), 1))
    return spark.createDataFrame(rows, DOCS_SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_held_out_accuracy(spark, labelled):
    docs, labels = labelled
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    out = toxicity(docs, labels).collect()
    assert len(out) == 600 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    # Labels of held-out rows change nothing.
    other = labels.withColumn("toxic", (labels["toxic"] + held_out(labels["doc_id"]).cast("int")) % 2)
    assert {(r.doc_id, r.score) for r in toxicity(docs, other).collect()} == {(r.doc_id, r.score) for r in out}


def test_edge_rows_and_missing_labels(spark, labelled):
    docs, labels = labelled
    edge = edge_docs(spark)
    scored = toxicity(docs.union(edge), labels.union(spark.createDataFrame([(None, 1, 1), (3, None, 1), (9999, 1, 1), (4, 1, 1), (4, 0, 1)], labels.schema)))
    assert scored.count() == 600 + edge.count() and scored.where("score IS NULL").count() == 0
    for some, score in ((labels.limit(0), 0.0), (labels.where("toxic = 1"), 1.0)):
        assert {r.score for r in toxicity(docs, some).collect()} == {score}
    assert toxicity(docs.limit(0), labels).count() == 0


def test_callers_columns_pass_whatever_their_names(spark, labelled):
    docs, labels = labelled
    score = toxicity_scorer(docs, labels)
    named = docs.limit(5).selectExpr("doc_id", "text", "1 AS features", "2 AS vector", "3 AS raw", "4 AS prediction", "5 AS probability", "6 AS rawPrediction", "7 AS label")
    out = score(named, keep_text=True)
    assert out.columns == [*named.columns, "score"] and {tuple(r)[2:9] for r in out.collect()} == {(1, 2, 3, 4, 5, 6, 7)}
    with pytest.raises(ValueError, match="score"):
        score(named.withColumnRenamed("raw", "score"))
