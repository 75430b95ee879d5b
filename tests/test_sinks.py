from datetime import datetime as dt
from decimal import Decimal as D
from pathlib import Path

import pytest

from starloom.operators.contracts import CONTRACTS
from starloom.operators.quality import CheckFailed
from starloom.plans.star import build_star
from starloom.sinks import (
    append_jdbc,
    append_new_keys,
    jdbc_appender,
    new_rows,
    preview,
    require_loaded,
    run_path,
    stage,
    write_both,
    write_csv_extract,
)
from starloom.sources import JdbcConnection, read_csv_extract

TEXTS = [
    (1, 'comma, quote " and\nnewline', "x"),
    (2, " outer blanks ", None),
    (3, "back\\slash", "ends with \\"),
    (4, None, 'only "quotes"'),
    (5, "crlf\r\nline", "é ☃"),
    (6, '"', "\\N is text? no: marker"),
]


def test_run_path():
    assert run_path("s3a://bucket/base/", "dim_staff", 17) == "s3a://bucket/base/dim_staff/17.csv"


def test_extract_round_trip_of_every_target(spark, sources, rows, tmp_path):
    for name, df in build_star(sources, open_only=False).items():
        path = run_path(str(tmp_path), name, 1)
        write_csv_extract(df, path)
        back = read_csv_extract(spark, path, CONTRACTS[name].schema())
        assert rows(back) == rows(df)


def test_extract_has_a_header_and_a_fixed_run_id(sources, spark, tmp_path):
    path = run_path(str(tmp_path), "city", 1)
    write_csv_extract(sources["city"], path)
    assert spark.read.csv(path, header=True).columns == ["city_id", "country_id", "city"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_csv_extract(sources["city"], path)


def test_plain_extract_trims_and_loses_empty_text(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "", " a "), (2, 'b, "c"\nd', None)], "n int, a string, b string")
    write_csv_extract(df, f"{tmp_path}/plain")
    back = read_csv_extract(spark, f"{tmp_path}/plain", df.schema)
    assert rows(back) == [(1, None, "a"), (2, 'b, "c"\nd', None)]


def test_lossless_extract(spark, rows, tmp_path):
    df = spark.createDataFrame([*TEXTS, (7, "", "")], "n int, a string, b string")
    write_csv_extract(df, f"{tmp_path}/lossless", lossless=True)
    assert rows(read_csv_extract(spark, f"{tmp_path}/lossless", df.schema, lossless=True)) == rows(df)


def test_extract_files_are_bounded(spark, tmp_path):
    write_csv_extract(spark.range(0, 100, 1, 1), f"{tmp_path}/bounded", rows_per_file=10)
    assert len(list((tmp_path / "bounded").glob("*.csv"))) == 10


def test_preview_prints_schema_and_ten_rows(spark, capfd):
    assert preview(spark.range(25).withColumnRenamed("id", "n")).count() == 10
    printed = capfd.readouterr().out
    assert "n: long" in printed


def test_stage_replaces_a_failed_attempt(spark, tmp_path):
    path = f"{tmp_path}/staged"
    stage(spark.range(5), path)
    assert stage(spark.range(3), path).count() == 3


def test_write_both_gives_every_sink_the_same_rows(spark, tmp_path):
    # random values would differ if each sink computed the frame again
    df = spark.range(1_000).selectExpr("id", "rand() AS r")
    seen = []
    write_both(df, f"{tmp_path}/staged", [lambda d: seen.append(d.collect()) for _ in range(2)])
    assert sorted(seen[0]) == sorted(seen[1])


def test_new_rows(spark, rows):
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "d")], "k int, v string")
    existing = spark.createDataFrame([(1, "old"), (1, "older"), (9, "x")], "k int, v string")
    assert rows(new_rows(new, existing, "k")) == [(2, "b"), (3, "c"), (3, "d")]


def test_require_loaded_counts_rows_per_key(spark):
    staged = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    require_loaded("t", staged, staged.union(staged.limit(1)), "k")
    for lost in (staged.where("k = 1"), staged.distinct(), staged.limit(0)):
        with pytest.raises(CheckFailed, match="table t lacks"):
            require_loaded("t", staged, lost, "k")


def test_append_new_keys_makes_a_second_load_harmless(spark, rows, tmp_path):
    path = f"{tmp_path}/target"
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    second = spark.createDataFrame([(2, "changed"), (5, "e")], "k int, v string")

    def append(df):
        df.write.mode("append").parquet(path)

    append(first)
    for batch in (first, second, second):
        append_new_keys(batch, spark.read.parquet(path), "k", append)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b"), (5, "e")]
    append_new_keys(first.limit(0), spark.read.parquet(path), "k", append)
    append(first)
    assert spark.read.parquet(path).count() == 5


def test_append_new_keys_pushes_the_key_range_into_the_target_scan(spark, tmp_path):
    spark.range(100).write.parquet(f"{tmp_path}/target")
    plans = []

    def append(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    append_new_keys(spark.range(90, 110), spark.read.parquet(f"{tmp_path}/target"), "id", append)
    assert "GreaterThanOrEqual(id,90)" in plans[0] and "LessThanOrEqual(id,109)" in plans[0]


class FakeWriter:
    def __init__(self):
        self.calls = {}

    @property
    def write(self):
        return self

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def mode(self, mode):
        self.calls["mode"] = mode
        return self

    def save(self):
        self.calls["saved"] = True


WAREHOUSE = JdbcConnection("jdbc:any://host/db", "any.Driver", "me", "secret")


def test_append_jdbc_options():
    df = FakeWriter()
    append_jdbc(df, WAREHOUSE, "dim_staff", CONTRACTS["dim_staff"], max_connections=8)
    options = df.calls["options"]
    assert (df.calls["format"], df.calls["mode"], df.calls["saved"]) == ("jdbc", "append", True)
    assert options["dbtable"] == "dim_staff" and options["numPartitions"] == "8"
    assert options["user"] == "me" and options["password"] == "secret"
    assert "district varchar(20)" in options["createTableColumnTypes"]


def test_jdbc_appender_is_a_load_sink():
    df = FakeWriter()
    jdbc_appender(WAREHOUSE, CONTRACTS)("fact_sales", df)
    assert df.calls["options"]["dbtable"] == "fact_sales"
    assert "createTableColumnTypes" not in df.calls["options"]
    assert "numPartitions" not in df.calls["options"]


def test_jdbc_write_reaches_spark(spark):
    with pytest.raises(Exception, match="any.Driver"):
        append_jdbc(spark.range(1), WAREHOUSE, "t")


def test_types_survive_staging(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [(D("1.50"), dt(2005, 5, 24, 10), ["a", None])], "d decimal(12,2), t timestamp, a array<string>"
    ).selectExpr("*", "CAST(t AS TIMESTAMP_NTZ) AS n")
    staged = stage(df, f"{tmp_path}/types")
    assert [f.dataType for f in staged.schema] == [f.dataType for f in df.schema]
    assert str(rows(staged)) == str(rows(df))


def test_new_rows_move_keys_only_where_few_are_lacking(spark, rows, tmp_path):
    old = stage(spark.range(2_000).selectExpr("IF(id < 3, NULL, id) AS k", "uuid() AS v"), f"{tmp_path}/old")
    more = spark.createDataFrame([(None, "x"), (5, "y"), (9_000, "z"), (9_000, "z")], "k bigint, v string")
    new = stage(old.unionAll(more), f"{tmp_path}/new")
    same = new_rows(old, old, "k", f"{tmp_path}/none")
    assert rows(same) == []
    fresh = new_rows(new, old.where("k IS NULL OR k != 7"), "k", f"{tmp_path}/some")
    assert rows(fresh) == sorted([(7, old.where("k = 7").first()["v"]), *((r["k"], r["v"]) for r in more.collect())], key=repr)
    assert "Exchange hashpartitioning" not in same._jdf.queryExecution().executedPlan().toString()


def test_a_compressed_extract_reads_back(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, None), (3, 'c"d')], "k int, v string")
    for lossless in (False, True):
        path = f"{tmp_path}/{lossless}.csv"
        write_csv_extract(df, path, lossless, compression="gzip")
        assert list(Path(path).glob("*.csv.gz")) and not list(Path(path).glob("*.csv"))
        assert rows(read_csv_extract(spark, path, df.schema, lossless)) == rows(df)
