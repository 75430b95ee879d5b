"""Sizes of lookups, measured in one pass, and what follows from them for joins of lookups."""

import random

from pyspark.sql import functions as F

from starloom.operators import joins
from starloom.operators.dimensions import flatten_geography
from starloom.operators.joins import ProbedJoin, Size, is_small, lookup_sizes
from starloom.plans import build_star, star_sizes
from starloom.sinks import write_csv_extract
from starloom.sources import read_csv_extract


def test_sizes_are_exact(spark):
    df = spark.createDataFrame([(1, "ab"), (1, "é"), (2, None), (None, "")], "k int, t string")
    assert lookup_sizes({"a": (df, "k"), "b": (df.limit(0), "k"), "c": (df.limit(1), "k")}) == {
        "a": Size(4, 4 * 32 + 4, 34, 2), "b": Size(0, 0, 0, 1), "c": Size(1, 34, 34, 1),
    }
    assert lookup_sizes({}) == {}


def test_keys_of_large_lookups_are_not_counted(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 5)
    df = spark.range(6).select((F.col("id") % 2).alias("k"))
    assert lookup_sizes({"a": (df, "k")})["a"] == Size(6, 96, 16, 6)
    assert not lookup_sizes({"a": (df, "k")})["a"].fits() and is_small(df.limit(5))


def test_bounds_hold_for_any_join_of_lookups(spark):
    rng = random.Random(4)
    for _ in range(4):
        frames = {}
        for name, key, other in (("a", "x", "y"), ("b", "y", "z"), ("c", "z", "w")):
            rows = [(rng.randint(0, 6), rng.randint(0, 6), "t" * rng.randint(0, 9)) for _ in range(rng.randint(1, 25))]
            frames[name] = (spark.createDataFrame(rows, f"{key} int, {other} int, t{name} string"), key)
        sizes = lookup_sizes(frames)
        inner = frames["b"][0].join(frames["c"][0], "z").drop("z")
        outer = frames["a"][0].join(inner, "y").drop("y")
        bound_inner = sizes["b"].looked_up(sizes["c"])
        bound = sizes["a"].looked_up(bound_inner)
        found = lookup_sizes({"inner": (inner, "y"), "outer": (outer, "x")})
        for known, most in ((found["inner"], bound_inner), (found["outer"], bound)):
            assert known.rows <= most.rows and known.bytes <= most.bytes and known.longest <= most.longest and known.times <= most.times


def test_named_lookups_are_not_measured_again(spark, sources, monkeypatch, rows):
    expected = {name: rows(df) for name, df in build_star(sources).items()}
    sizes = star_sizes(sources)
    assert {"country", "places", "geography", "managers", "language", "category", "films", "items", "rented"} <= set(sizes)
    monkeypatch.setattr(joins, "is_small", lambda *a: 1 / 0)
    star = build_star(sources, join=ProbedJoin(sizes=sizes))
    assert {name: rows(df) for name, df in star.items()} == expected
    only = star_sizes(sources, ["dim_staff"])
    assert set(only) == {"country", "city", "address", "places", "geography"} and star_sizes(sources, ["dim_rental_date"]) == {}


def test_sizes_run_no_join(spark, sources):
    """Two jobs: the scans, and the keys of small lookups."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sizes", "sizes")
    star_sizes({n: spark.createDataFrame(df.collect(), df.schema) for n, df in sources.items()}, ["dim_customer"])
    assert 1 <= len(tracker.getJobIdsForGroup("sizes"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plain = flatten_geography(sources["address"], sources["city"], sources["country"])
    sizes = star_sizes(sources, ["dim_customer"])
    assert plain.count() <= sizes["geography"].rows


# -- extracts


def test_lossless_extract_is_one_line_a_record_and_split(spark, tmp_path, rows):
    texts = ["a\nb", "a\\nb", "\\", "\\b\\n", "\r\n", "\\\r\\\n", '"\n"', "", None, "\\N", " \x85\x0b\x0c", "x" * 50_000]
    df = spark.createDataFrame([(i, texts[i % len(texts)], texts[i // 7 % len(texts)]) for i in range(600)], "n int, a string, b string")
    path = f"{tmp_path}/lossless"
    write_csv_extract(df.coalesce(1), path, lossless=True)
    files = list((tmp_path / "lossless").glob("*.csv"))
    assert len(files) == 1 and files[0].read_bytes().count(b"\n") == 601
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        back = read_csv_extract(spark, path, df.schema, lossless=True)
        assert back.rdd.getNumPartitions() > 4
        assert rows(back) == rows(df)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_are_bounded_by_bytes(spark, tmp_path, rows):
    df = spark.range(0, 400, 1, 2).select("id", F.concat(F.repeat(F.lit('"x'), 250), F.col("id").cast("string")).alias("t"))
    for lossless in (False, True):
        path = tmp_path / f"b{lossless}"
        write_csv_extract(df, str(path), lossless=lossless, bytes_per_file=40_000)
        sizes = [p.stat().st_size for p in path.glob("*.csv")]
        assert max(sizes) <= 40_000 and len(sizes) >= 10
        assert rows(read_csv_extract(spark, str(path), df.schema, lossless=lossless)) == rows(df)
    write_csv_extract(df.limit(0), f"{tmp_path}/none")
    write_csv_extract(df, f"{tmp_path}/one", bytes_per_file=1)
    assert len(list((tmp_path / "one").glob("*.csv"))) == 400
