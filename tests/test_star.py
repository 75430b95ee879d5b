import pytest

from starloom.operators.contracts import CONTRACTS
from starloom.operators.quality import CheckFailed
from starloom.plans import build_star, land_sources, load_star
from starloom.sinks import append_new_keys
from starloom.sources import read_csv_extract


def test_load_order_and_contract_order_agree(sources):
    assert list(build_star(sources)) == list(CONTRACTS)


def test_landed_sources_build_the_same_star(sources, rows, tmp_path):
    landed = land_sources(sources, f"{tmp_path}/landed")
    direct, staged = build_star(sources), build_star(landed)
    for name in direct:
        assert rows(staged[name]) == rows(direct[name])


def run(spark, sources, tmp_path, run_id="1", **kw):
    order = []

    def warehouse(name, df):
        order.append(name)
        df.write.mode("append").parquet(f"{tmp_path}/warehouse/{name}")

    staged = load_star(
        spark, sources, run_id, f"{tmp_path}/work", f"{tmp_path}/extracts", warehouse, **kw
    )
    return staged, order


def test_load_star_fills_both_sinks(spark, sources, rows, tmp_path):
    staged, order = run(spark, sources, tmp_path)
    assert set(order) == set(CONTRACTS) and order[-1] == "fact_sales"
    for name, df in build_star(sources).items():
        expected = rows(df)
        assert rows(staged[name]) == expected
        assert rows(spark.read.parquet(f"{tmp_path}/warehouse/{name}")) == expected
        extract = read_csv_extract(
            spark, f"{tmp_path}/extracts/{name}/1.csv", CONTRACTS[name].schema()
        )
        assert rows(extract) == expected


def test_second_run_appends_again(spark, sources, tmp_path):
    for run_id in ("1", "2"):
        run(spark, sources, tmp_path, run_id)
    assert spark.read.parquet(f"{tmp_path}/warehouse/fact_sales").count() == 6


def test_second_run_with_key_dedup_adds_nothing(spark, sources, tmp_path):
    base = f"{tmp_path}/dedup"
    for run_id in ("1", "2"):

        def warehouse(name, df, run_id=run_id):
            def append(d):
                d.write.mode("append").parquet(f"{base}/{name}")

            if run_id == "1":
                append(df)
            else:
                existing = spark.read.parquet(f"{base}/{name}")
                append_new_keys(df, existing, CONTRACTS[name].key, append)

        load_star(
            spark, sources, run_id, f"{tmp_path}/work", f"{tmp_path}/extracts", warehouse, land=False
        )
    assert spark.read.parquet(f"{base}/fact_sales").count() == 3
    assert spark.read.parquet(f"{base}/dim_movie").count() == 3


def test_empty_table_stops_the_load_before_any_sink(spark, sources, tmp_path):
    empty = {**sources, "store": sources["store"].limit(0)}
    with pytest.raises(CheckFailed, match="dim_store"):
        run(spark, empty, tmp_path)
    assert not (tmp_path / "warehouse").exists() and not (tmp_path / "extracts").exists()


def test_strict_load_stops_on_a_broken_constraint(spark, sources, tmp_path):
    with pytest.raises(CheckFailed, match="dim_movie.movie_key"):
        run(spark, sources, tmp_path, strict=True)
    clean = {
        **sources,
        "film_category": sources["film_category"].where("film_id = 1"),
        "staff": sources["staff"].where("active IS NOT NULL"),
        "payment": sources["payment"].where("payment_id = 1"),
    }
    clean["staff"] = clean["staff"].withColumn("address_id", clean["staff"]["address_id"] * 0 + 1)
    staged, _ = run(spark, clean, tmp_path, run_id="2", strict=True)
    assert staged["fact_sales"].count() == 1


class Warehouse:
    """Parquet folders; ``breaks`` names a table whose append fails, ``loses`` one that drops rows."""

    def __init__(self, spark, path, breaks=None, loses=None):
        self.spark, self.path, self.breaks, self.loses, self.appends = spark, path, breaks, loses, []

    def append(self, name, df):
        if name == self.breaks:
            raise OSError(f"{name} failed")
        self.appends.append(name)
        df.limit(1 if name == self.loses else 1_000_000).write.mode("append").parquet(f"{self.path}/{name}")

    def read(self, name):
        if name not in self.appends:
            return None
        return self.spark.read.parquet(f"{self.path}/{name}")


def load(spark, sources, tmp_path, warehouse, run_id="1", **kw):
    return load_star(
        spark, sources, run_id, f"{tmp_path}/work", f"{tmp_path}/extracts", warehouse.append, read_back=warehouse.read, **kw
    )


@pytest.mark.parametrize("breaks", ["fact_sales", "dim_store"])
def test_a_failed_load_is_finished_by_the_same_run(spark, sources, rows, tmp_path, breaks):
    warehouse = Warehouse(spark, tmp_path / "w", breaks=breaks)
    with pytest.raises(OSError, match=breaks):
        load(spark, sources, tmp_path, warehouse)
    warehouse.breaks = None
    load(spark, sources, tmp_path, warehouse)
    load(spark, sources, tmp_path, warehouse)
    assert sorted(warehouse.appends) == sorted(CONTRACTS)
    for name, df in build_star(sources).items():
        assert rows(warehouse.read(name)) == rows(df)


def test_a_new_run_by_new_keys_adds_only_them(spark, sources, rows, tmp_path):
    warehouse = Warehouse(spark, tmp_path / "w")
    load(spark, {**sources, "payment": sources["payment"].where("payment_id = 1")}, tmp_path, warehouse, new_keys=True)
    load(spark, sources, tmp_path, warehouse, run_id="2", new_keys=True)
    for name in ("fact_sales", "dim_customer", "dim_movie"):
        assert rows(warehouse.read(name)) == rows(build_star(sources)[name])
    with pytest.raises(ValueError, match="read_back"):
        load_star(spark, sources, "3", f"{tmp_path}/work", f"{tmp_path}/x", warehouse.append, new_keys=True)


def test_lost_rows_are_noticed_and_named(spark, sources, tmp_path):
    with pytest.raises(CheckFailed, match="fact_sales lacks 2 rows"):
        load(spark, sources, tmp_path, Warehouse(spark, tmp_path / "w", loses="fact_sales"))


def test_single_tables(spark, sources, tmp_path, capfd):
    warehouse = Warehouse(spark, tmp_path / "w")
    staged = load(spark, sources, tmp_path, warehouse, only=["dim_rental_date", "dim_store"], preview_rows=1, lossless=True)
    assert set(staged) == set(warehouse.appends) == {"dim_rental_date", "dim_store"}
    assert "store_key" in capfd.readouterr().out
    with pytest.raises(ValueError, match="dim_nothing"):
        build_star(sources, only=["dim_nothing"])
