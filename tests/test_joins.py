import pytest
from pyspark.sql import functions as F

from starloom.operators import joins
from starloom.operators.facts import fact_sales
from starloom.operators.joins import (
    HotKeys,
    ProbedJoin,
    declared_join,
    dropped_rows,
    hot_keys,
    is_small,
    salted_join,
    split_join,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 rows, a third of them on key 7; two keys NULL, one without a partner."""
    left = spark.range(30_000).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id").isin(1, 2), None)
        .otherwise(F.col("id") % 5_000)
        .cast("bigint")
        .alias("k"),
    )
    right = spark.range(4_999).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    twice = right.unionByName(right.where("k IN (7, 11)").withColumn("v", F.lit(-1)))
    return left, twice


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_finds_the_heavy_hitter_only(skewed):
    left, _ = skewed
    hot = hot_keys(left, "k")
    assert dict(hot.rows) == {7: left.where("k = 7").count()}
    assert hot.reducer == pytest.approx(29_998 / 8)


def test_hot_keys_of_nothing_and_of_even_data(skewed, spark):
    left, _ = skewed
    assert not hot_keys(left.limit(0), "k").rows
    assert not hot_keys(spark.range(20_000).select((F.col("id") % 1_000).alias("k")), "k").rows


def test_hot_keys_are_not_capped(spark):
    df = spark.range(8_000).select((F.col("id") % 4).alias("k"))
    assert len(hot_keys(df, "k").rows) == 4
    assert len(hot_keys(df, "k", hot_reducers=0.5).rows) == 4


@pytest.mark.parametrize("data_type", ["int", "smallint", "string", "decimal(12,0)", "date"])
def test_hot_keys_of_other_types(spark, data_type):
    key = F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 1_000).cast("int")
    key = F.date_add(F.lit("2000-01-01").cast("date"), key) if data_type == "date" else key.cast(data_type)
    df = spark.range(20_000).select(key.alias("k"))
    hot = hot_keys(df, "k")
    assert len(hot.rows) == 1
    for join in (salted_join, split_join):
        assert join(df.withColumn("n", F.lit(1)), df.select("k").distinct(), "k", hot).count() == 20_000


HOT = HotKeys({7: 10_000, 11: 600, 123_456: 300}, 300)


def test_each_key_has_its_own_fan_out(skewed):
    assert [HOT.fan_out(k) for k in HOT.rows] == [133, 8, 4]
    _, right = skewed
    salts = {r["k"]: r["_salts"] for r in HOT.frame(right, "k").collect()}
    assert salts == {7: 133, 11: 8, 123_456: 4}


@pytest.mark.parametrize("join", [salted_join, split_join])
def test_hot_joins_give_the_declared_rows(skewed, rows, join):
    left, right = skewed
    joined, declared = join(left, right, "k", HOT), declared_join(left, right, "k")
    assert sorted(joined.columns) == sorted(declared.columns)
    assert rows(joined.select(declared.columns)) == rows(declared)


@pytest.fixture
def plain_shuffles(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


def largest_part(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_salts_spread_the_hot_key(skewed, plain_shuffles):
    left, right = skewed
    whole = largest_part(declared_join(left, right, "k").where("k = 7"))
    spread = largest_part(salted_join(left, right, "k", hot_keys(left, "k")).where("k = 7"))
    assert whole > 20_000 and spread < whole / 2


def test_a_third_of_the_payments_on_one_item_stays_spread(spark, plain_shuffles):
    """The fact's second join is measured on payments, not on the rentals behind them."""
    payment = spark.range(20_000).selectExpr(
        "CAST(id AS INT) AS payment_id", "CAST(1 AS SMALLINT) AS customer_id", "CAST(1 AS SMALLINT) AS staff_id",
        "CAST(IF(id % 3 = 0, 5, id % 900) AS INT) AS rental_id", "CAST(1 AS DECIMAL(12,2)) AS amount", "TIMESTAMP '2005-05-24' AS payment_date",
    )
    rental = spark.range(900).selectExpr("CAST(id AS INT) AS rental_id", "CAST(id AS INT) AS inventory_id", "TIMESTAMP '2005-05-24' AS rental_date", "CAST(NULL AS TIMESTAMP) AS return_date")
    inventory = spark.range(900).selectExpr("CAST(id AS INT) AS inventory_id", "CAST(1 AS SMALLINT) AS store_id", "CAST(1 AS SMALLINT) AS film_id")
    for rows in (100, 0):  # hot partners broadcast, or salted
        df = fact_sales(payment, rental, inventory, join=ProbedJoin(broadcast_rows=rows))
        assert df.count() == 20_000
        assert largest_part(df) < 20_000 / 3


def test_is_small_by_rows_and_by_bytes(spark, monkeypatch):
    def small(df, max_rows=10_000, max_bytes=10_000_000):
        monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", max_rows)
        monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", max_bytes)
        return is_small(df)

    df = spark.range(1_000).select("id", F.repeat(F.lit("x"), 1_000).alias("t"))
    assert small(df)
    assert not small(df, max_rows=999)
    assert not small(df, max_bytes=1_000_000)
    assert small(df.drop("t"), max_bytes=16_000)
    assert not small(df.drop("t"), max_bytes=15_999)
    assert small(df.where("id < 0"))
    arrays = spark.range(10).select(F.array_repeat(F.lit("abcd"), 1_000).alias("a"))
    assert not small(arrays, max_bytes=40_000)


def test_probed_join_broadcasts_a_measured_lookup(skewed, rows, plain_shuffles):
    left, right = skewed
    df = ProbedJoin()(left, right, "k")
    assert "BroadcastHashJoin" in plan(df)
    assert rows(df) == rows(declared_join(left, right, "k"))


def test_probed_join_splits_hot_keys_off(skewed, rows, plain_shuffles):
    left, right = skewed
    df = ProbedJoin(broadcast_rows=100)(left, right, "k")
    text = plan(df)
    assert "Union" in text and "BroadcastHashJoin" in text and "SortMergeJoin" in text
    assert rows(df) == rows(declared_join(left, right, "k"))


def test_probed_join_salts_when_the_partners_are_many(skewed, rows):
    left, right = skewed
    df = ProbedJoin(broadcast_rows=1)(left, right, "k")
    assert "_salt" in plan(df)
    assert rows(df) == rows(declared_join(left, right, "k"))


def test_probed_join_without_hot_keys_is_plain(spark):
    left = spark.range(20_000).withColumnRenamed("id", "k")
    df = ProbedJoin(broadcast_rows=100)(left, left, "k")
    assert "_salt" not in plan(df) and "Union" not in plan(df)
    assert df.count() == 20_000


def test_fact_is_the_same_under_every_join(sources, rows):
    s = sources
    expected = rows(fact_sales(s["payment"], s["rental"], s["inventory"], open_only=False))
    for bound in (100, 1, 0):
        for hot in (2.0, 0.1):
            join = ProbedJoin(broadcast_rows=bound, hot_reducers=hot)
            assert rows(fact_sales(s["payment"], s["rental"], s["inventory"], open_only=False, join=join)) == expected


def test_dropped_rows(sources, spark):
    s = sources
    assert dropped_rows(s["customer"], s["address"], "address_id").first()["dropped"] == 2
    assert dropped_rows(s["payment"], s["rental"], "rental_id").first()["dropped"] == 2
    assert dropped_rows(s["city"], s["city"], "city_id").first()["dropped"] == 0
    assert dropped_rows(s["city"].limit(0), s["city"], "city_id").first()["dropped"] == 0


@pytest.mark.parametrize("buckets", [1, 64])
def test_hot_keys_count_keys_of_large_buckets_only(spark, monkeypatch, buckets):
    monkeypatch.setattr("starloom.operators.joins.BUCKETS_A_REDUCER", buckets)
    df = spark.range(40_000).select(F.expr("IF(id % 4 = 0, -3, IF(id % 4 = 1, -1, id))").alias("k"))
    hot = hot_keys(df, "k")
    assert hot.rows == {-3: 10_000, -1: 10_000} and hot.reducer == 5_000
    small = spark.createDataFrame([(None,), (7,), (7,), (7,), (8,)], "k int")
    assert hot_keys(small, "k").rows == {7: 3}
