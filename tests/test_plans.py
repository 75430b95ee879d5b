"""The physical plans that the builders are meant to get."""

import pytest

from starloom.operators.contracts import CONTRACTS
from starloom.operators.dimensions import date_dim
from starloom.operators.facts import fact_sales
from starloom.operators.quality import check_foreign_keys, check_not_empty
from starloom.plans.queries import q_fact_sales_all
from starloom.plans.star import build_star
from starloom.plans.standins import source_tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given_sources(spark):
    return source_tables(spark, SF_DIR)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_scans_only_what_it_needs(given_sources):
    s = given_sources
    text = plan(fact_sales(s["payment"], s["rental"], s["inventory"], open_only=False))
    assert "o_totalprice" not in text and "l_tax" not in text and "c_acctbal" not in text
    assert "IsNotNull(o_custkey)" in text


def test_open_filter_reaches_the_scan(spark, sources, tmp_path):
    path = f"{tmp_path}/rental"
    sources["rental"].write.parquet(path)
    text = plan(fact_sales(sources["payment"], spark.read.parquet(path), sources["inventory"]))
    assert "IsNull(return_date)" in text


def test_payment_is_shuffled_once(given_sources, no_broadcast):
    s = given_sources
    text = plan(fact_sales(s["payment"], s["rental"], s["inventory"], open_only=False))
    # inventory, rental, rental with inventory, payment
    assert text.count("Exchange hashpartitioning") == 4
    assert text.count("l_orderkey") > 0 and text.count("SortMergeJoin") == 2


def test_date_dim_shuffles_one_date_column(given_sources):
    text = plan(date_dim(given_sources["rental"], "rental_date"))
    assert text.count("Exchange") == 1
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text
    assert "IsNotNull(o_orderdate)" in text


def scans(df, column):
    """Scan nodes of the plan that read ``column``; nodes of the tree, so long paths cut nothing off."""
    def nodes(node):
        yield node
        children = node.children()
        for i in range(children.size()):
            yield from nodes(children.apply(i))

    root = df._jdf.queryExecution().sparkPlan()
    found = [n for n in nodes(root) if n.nodeName().startswith("Scan")]
    return sum(column in [n.schema().apply(i).name() for i in range(n.schema().size())] for n in found)


def test_foreign_keys_scan_the_fact_once(spark, sources, tmp_path):
    star = build_star(sources)
    folder = tmp_path / ("long" * 30)
    star["fact_sales"].write.parquet(f"{folder}/fact")
    frames = {**star, "fact_sales": spark.read.parquet(f"{folder}/fact")}
    assert scans(check_foreign_keys(frames, CONTRACTS), "movie_key") == 1


def test_registered_fact_query_broadcasts_what_it_measured(spark, no_broadcast):
    df = q_fact_sales_all(spark, SF_DIR)
    assert plan(df).count("BroadcastHashJoin") == 2 and scans(df, "l_orderkey") == 1


def test_not_empty_stops_at_the_first_row(given_sources):
    text = plan(check_not_empty({"payment": given_sources["payment"]}))
    assert "Limit" in text


def test_no_python_and_no_cross_join_in_any_plan(given_sources):
    for df in build_star(given_sources).values():
        text = plan(df)
        assert "Python" not in text and "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text
