"""Rows must keep their keys when Spark cuts the same files differently from one scan to the next."""

import pytest

import corpus_pipeline
from starloom.llm import lines, simhash, suffix
from starloom.llm.common import components, row_key, staged
from tests.llm.edge_rows import sentence

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def docs(spark, tmp_path):
    passage = " ".join(f"shared{i}" for i in range(60))
    texts = [f"{sentence(i % 30, 60)}\nline one {i % 7}\nline two {i % 7}\nline three {i % 7}\n{passage if i % 5 == 0 else i}" for i in range(400)]
    rows = [(i // 2, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.option(
        "parquet.block.size", 4096
    ).parquet(str(tmp_path / "d"))
    return spark.read.parquet(str(tmp_path / "d"))


@pytest.fixture
def moving_split(spark, monkeypatch):
    """Every staged table, written after one scan of the documents, changes how files are cut for the next."""
    sizes = ["8k", "128m", "16k", "64k"]

    def changing(df, name):
        out = staged(df, name)
        sizes.append(sizes.pop(0))
        spark.conf.set(SPLIT, sizes[0])
        return out

    for module in (lines, simhash, suffix):
        monkeypatch.setattr(module, "staged", changing)
    yield
    spark.conf.unset(SPLIT)


OPERATORS = {
    "lines": lambda d: lines.line_dedup(d).select("doc_id", "kept"),
    "passages": lambda d: suffix.suffix_dedup(d).select("doc_id", "kept"),
    "near_copies": lambda d: corpus_pipeline.drop_near_copies(d.sparkSession, d, "").select("doc_id", "text"),
}


def result(name, docs):
    return sorted((tuple(r) for r in OPERATORS[name](docs).collect()), key=repr)


@pytest.fixture
def still(docs):
    return {name: result(name, docs) for name in OPERATORS}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_same_rows_whatever_the_split(docs, still, moving_split, name):
    moved = result(name, docs)
    assert moved == still[name]
    if name != "near_copies":
        assert moved != sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)


def test_keys_are_single(docs):
    assert docs.select(row_key().alias("k")).distinct().count() == 400


def test_a_star_of_links(spark):
    links = spark.range(1, 5001).selectExpr("0L AS a", "id AS b")
    got = components(links)
    assert got.count() == 5001 and got.select("component").distinct().collect()[0][0] == 0
