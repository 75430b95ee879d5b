"""What the registered queries return, and what they leave behind."""

from pathlib import Path

import pytest

from starloom.llm.queries import QUERIES
from starloom.sources import shared_folder

SF_DIR = "/root/testdata/sf0.001"
ROWS = {"documents": 200, "embeddings": 500}
EXPECTED = {
    "op1_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2_sentencepiece": "doc_id bigint, n_tokens bigint, ids_crc32 bigint, decoded_chars bigint, round_trip boolean",
    "op3_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op4_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op5_lattice": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op6_tokens": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op7_lines": "doc_id bigint, n_lines bigint, n_removed bigint, kept_md5 string",
    "op8_suffix": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op9_topk": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op10_chat": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op11_centroids": "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    "op12_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op13_importance": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
}
ONE_ROW_A_DOCUMENT = ("op1", "op2", "op4", "op6", "op7", "op8", "op12", "op13")


def folders(spark):
    return {p.name for p in Path(f"{shared_folder(spark).removeprefix('file:')}/llm").glob("*")}


def test_every_query_is_listed():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", list(EXPECTED))
def test_columns_types_rows_and_folders(spark, name):
    before = folders(spark)
    df = QUERIES[name](spark, SF_DIR)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == EXPECTED[name]
    left = folders(spark) - before
    assert len(left) <= 1 and all(next(iter(left)) in f for f in df.inputFiles() if left)
    if name.split("_")[0] in ONE_ROW_A_DOCUMENT:
        ids = [r.doc_id for r in df.select("doc_id").collect()]
        assert sorted(ids) == list(range(ROWS["documents"]))
    elif name in ("op5_lattice", "op11_centroids"):
        assert df.count() == ROWS["embeddings"]
    else:
        assert df.count() > 0
