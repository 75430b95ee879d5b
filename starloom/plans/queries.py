"""The registered queries: each operator over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.contracts import CONTRACTS, conform, create_if_absent
from starloom.operators.dimensions import (
    date_dim,
    dim_customer,
    dim_movie,
    dim_staff,
    dim_store,
    flatten_geography,
)
from starloom.operators.facts import fact_sales
from starloom.operators.joins import Join, ProbedJoin, dropped_rows, hot_keys, salted_join, split_join
from starloom.operators.quality import (
    check_all,
    check_foreign_keys,
    check_length,
    check_not_empty,
    check_not_null,
    check_unique_key,
    row_counts,
)
from starloom.plans.standins import given, source_tables
from starloom.plans.star import build_star, load_star, star_sizes, take_cut, within_cut
from starloom.sinks.csv_extract import run_path, write_csv_extract
from starloom.sinks.load import append_new_keys, preview, stage, write_both
from starloom.sinks.runs import FileWarehouse
from starloom.sources.files import read_csv_extract
from starloom.sources.session import remove_folder, scratch_folder, shared_folder
from starloom.sources.views import register_views

Query = Callable[[SparkSession, str], DataFrame]

# The given keys outgrow the declared 16-bit ids from scale factor 1 on.
WIDE = {name: contract.widened() for name, contract in CONTRACTS.items()}


def _geography(s: Mapping[str, DataFrame], join: Join) -> DataFrame:
    return flatten_geography(s["address"], s["city"], s["country"], join)


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/starloom/{uuid.uuid4().hex}"


def _tidy(spark: SparkSession, work: Callable[[str], DataFrame]) -> DataFrame:
    """What ``work`` makes in a folder of its own; of that folder nothing but the result stays."""
    with scratch_folder(spark, "query") as folder:
        return stage(work(folder), _run_folder(spark))


def _sized(s: Mapping[str, DataFrame], table: str, open_only: bool = True) -> Join:
    return ProbedJoin(sizes=star_sizes(s, [table], open_only))


def _star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    s = source_tables(spark, sf_dir)
    join = ProbedJoin(sizes=star_sizes(s, open_only=False))
    return build_star(s, open_only=False, join=join, contracts=WIDE)


def q_dim_payment_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dim(source_tables(spark, sf_dir)["payment"], "payment_date")


def q_dim_rental_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dim(source_tables(spark, sf_dir)["rental"], "rental_date")


def q_dim_return_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dim(source_tables(spark, sf_dir)["rental"], "return_date")


def q_dim_event_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dim(given(spark, sf_dir, "events"), "ts")


def q_dim_rental_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dim(source_tables(spark, sf_dir)["rental"], "rental_date", as_text=True)


def q_dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = source_tables(spark, sf_dir)
    join = _sized(s, "dim_customer")
    return dim_customer(s["customer"], _geography(s, join), join)


def q_dim_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = source_tables(spark, sf_dir)
    join = _sized(s, "dim_staff")
    return dim_staff(s["staff"], _geography(s, join), join)


def q_dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = source_tables(spark, sf_dir)
    join = _sized(s, "dim_store")
    return dim_store(s["store"], s["staff"], _geography(s, join), join)


def q_dim_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = source_tables(spark, sf_dir)
    join = _sized(s, "dim_movie")
    return dim_movie(s["film"], s["language"], s["film_category"], s["category"], join)


def _fact(spark: SparkSession, sf_dir: str, open_only: bool) -> DataFrame:
    s = source_tables(spark, sf_dir)
    join = _sized(s, "fact_sales", open_only)
    return fact_sales(s["payment"], s["rental"], s["inventory"], open_only, join)


def q_fact_sales_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, open_only=True)


def q_fact_sales_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, open_only=False)


def q_fact_sales_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten-row preview is unordered, so only its size is comparable."""
    return preview(_fact(spark, sf_dir, open_only=True)).agg(F.count(F.lit(1)).alias("n"))


def q_sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each city's customers paid for films of each rating on rentals still open."""
    register_views(source_tables(spark, sf_dir), prefix="src_")
    return spark.sql(
        """
        SELECT t.city, f.rating, count(*) AS payments, sum(p.amount) AS paid
        FROM src_rental r
        JOIN src_payment p ON p.rental_id = r.rental_id
        JOIN src_inventory i ON i.inventory_id = r.inventory_id
        JOIN src_film f ON f.film_id = i.film_id
        JOIN src_customer c ON c.customer_id = p.customer_id
        JOIN src_address a ON a.address_id = c.address_id
        JOIN src_city t ON t.city_id = a.city_id
        WHERE r.return_date IS NULL
        GROUP BY t.city, f.rating
        """
    )


def _skewed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line items with all returned ones on order 1, and the orders."""
    lines = given(spark, sf_dir, "lineitem").select(
        F.expr("IF(l_returnflag = 'R', 1L, l_orderkey)").alias("o_orderkey"), "l_partkey", "l_linenumber", "l_quantity"
    )
    return lines, given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


def q_split_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned line items, a third of all, on one order: its rows stay in place."""
    lines, orders = _skewed(spark, sf_dir)
    return split_join(lines, orders, "o_orderkey", hot_keys(lines, "o_orderkey", 1.0))


def q_salted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with that order's rows spread by salts."""
    lines, orders = _skewed(spark, sf_dir)
    return salted_join(lines, orders, "o_orderkey", hot_keys(lines, "o_orderkey", 1.0))


def q_dropped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = source_tables(spark, sf_dir)
    managers = s["staff"].withColumnRenamed("staff_id", "manager_staff_id")
    joins = [
        ("customer", s["customer"], s["address"], "address_id"),
        ("staff", s["staff"], s["address"], "address_id"),
        ("store", s["store"], managers, "manager_staff_id"),
        ("film", s["film"], s["film_category"], "film_id"),
        ("rental", s["rental"], s["inventory"], "inventory_id"),
        ("payment", s["payment"], s["rental"], "rental_id"),
        ("payment", s["payment"], s["staff"], "staff_id"),
        ("payment", s["payment"], s["customer"], "customer_id"),
    ]
    report = None
    for name, left, right, key in joins:
        row = dropped_rows(left, right, key).select(
            F.lit(name).alias("table"), F.lit(key).alias("column"), "dropped"
        )
        report = row if report is None else report.unionByName(row)
    return report


def q_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(_star(spark, sf_dir))


def q_check_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_not_empty(_star(spark, sf_dir))


def q_check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_not_null(_star(spark, sf_dir), WIDE)


def q_check_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique_key(_star(spark, sf_dir), WIDE)


def q_check_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_foreign_keys(_star(spark, sf_dir), WIDE)


def q_check_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_length(_star(spark, sf_dir), WIDE)


def q_check_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks over one staged star."""

    def checked(folder: str) -> DataFrame:
        staged = {name: stage(df, f"{folder}/{name}") for name, df in _star(spark, sf_dir).items()}
        return check_all(staged, WIDE)

    return _tidy(spark, checked)


def q_conformed_dim_rental_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(q_dim_rental_date(spark, sf_dir), CONTRACTS["dim_rental_date"])


def q_conformed_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(q_fact_sales_all(spark, sf_dir), WIDE["fact_sales"])


def q_created_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a date dimension from its contract, twice, and load it; only its files stay."""
    contract = WIDE["dim_rental_date"]
    name = f"dim_rental_date_{uuid.uuid4().hex}"
    location = f"{_run_folder(spark)}/{name}"
    for _ in range(2):
        create_if_absent(spark, contract, name, location)
    conform(q_dim_rental_date(spark, sf_dir), contract).write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(contract.schema()).parquet(location)


def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = WIDE["fact_sales"]
    path = run_path(_run_folder(spark), contract.table, "1")
    write_csv_extract(q_conformed_fact_sales(spark, sf_dir), path)
    return read_csv_extract(spark, path, contract.schema())


def q_csv_round_trip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole multi-line texts through an extract, unchanged; one line a record, so its files can be split."""
    documents = given(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", "source", "n_chars"
    )
    path = run_path(_run_folder(spark), "documents", "1")
    write_csv_extract(documents, path, lossless=True)
    return read_csv_extract(spark, path, documents.schema, lossless=True)


def q_append_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that the line items do not know yet, appended to a table of their own."""
    path = f"{_run_folder(spark)}/orders"
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    target = given(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    append_new_keys(
        orders, target, "o_orderkey", lambda rows: rows.write.mode("append").parquet(path)
    )
    return spark.read.schema(orders.schema).parquet(path)


def q_append_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under their order's key, after a load that broke off inside the keys: each is there once."""
    path = f"{_run_folder(spark)}/lines"
    lines = given(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    lines.where("l_suppkey % 3 = 0").write.parquet(path)
    append_new_keys(
        lines, spark.read.schema(lines.schema).parquet(path), "l_orderkey", lambda rows: rows.write.mode("append").parquet(path)
    )
    return spark.read.schema(lines.schema).parquet(path)


def q_file_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact published in two runs; the second broke off once, half written, and is repeated twice."""
    warehouse = FileWarehouse(spark, f"{_run_folder(spark)}/warehouse")
    fact = q_conformed_fact_sales(spark, sf_dir)
    early, late = fact.where("sales_key % 2 = 0"), fact.where("sales_key % 2 = 1")
    warehouse.append("fact_sales", early, "1")
    late.where("sales_key % 3 = 0").write.parquet(warehouse.run_folder("fact_sales", "2"))
    for _ in range(2):
        warehouse.append("fact_sales", late, "2")
    return warehouse.read("fact_sales")


def q_fact_sales_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payments up to a cut at half of every table's largest key."""
    s = source_tables(spark, sf_dir)

    def half(name: str, key: str) -> object:
        largest = s[name].agg(F.max(key)).first()[0]
        return largest // 2 if isinstance(largest, int) else largest

    cut = within_cut(s, take_cut(half))
    return fact_sales(cut["payment"], cut["rental"], cut["inventory"], False, _sized(cut, "fact_sales", False))


def _both_sinks(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, DataFrame]:
    contract = WIDE["fact_sales"]
    extract, warehouse = run_path(folder, contract.table, "1"), f"{folder}/warehouse"
    write_both(
        q_conformed_fact_sales(spark, sf_dir),
        f"{folder}/staged",
        [
            lambda df: write_csv_extract(df, extract),
            lambda df: df.write.mode("append").parquet(warehouse),
        ],
    )
    return {
        "extract": read_csv_extract(spark, extract, contract.schema()),
        "warehouse": spark.read.parquet(warehouse),
    }


def q_write_both_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact to an extract and to a warehouse folder from one computation."""
    return _tidy(spark, lambda folder: row_counts(_both_sinks(spark, sf_dir, folder)).withColumnRenamed("table", "sink"))


def q_write_both_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of both sinks."""
    folder = _run_folder(spark)
    sinks = [df.withColumn("sink", F.lit(name)) for name, df in _both_sinks(spark, sf_dir, folder).items()]
    remove_folder(spark, f"{folder}/staged")
    return sinks[0].unionByName(sinks[1])


def _load(spark: SparkSession, sf_dir: str, folder: str, run_id: str, **choices: object) -> dict[str, DataFrame]:
    def read_back(name: str) -> DataFrame | None:
        return spark.read.schema(WIDE[name].schema()).parquet(f"{base}/{name}") if name in loaded else None

    def warehouse(name: str, df: DataFrame) -> None:
        df.write.mode("append").option("compression", "zstd").parquet(f"{base}/{name}")
        loaded.add(name)

    loaded: set[str] = set(choices.pop("loaded", ()))
    base = choices.pop("base", f"{folder}/warehouse")
    return load_star(
        spark, source_tables(spark, sf_dir), run_id, folder, f"{folder}/extracts", warehouse,
        contracts=WIDE, read_back=read_back, **choices,
    )


def q_load_star_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole load without landing its sources; rows per table as the warehouse folder has them."""

    def counted(folder: str) -> DataFrame:
        staged = _load(spark, sf_dir, folder, "1", land=False)
        return row_counts({name: spark.read.parquet(f"{folder}/warehouse/{name}") for name in staged})

    return _tidy(spark, counted)


def q_load_star_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of landed sources, the second by new keys only; the warehouse's sales, which stay where they were loaded."""
    base = _run_folder(spark)
    others = [base]
    try:
        with scratch_folder(spark, "query") as folder:
            for run_id in ("1", "2"):
                loaded = () if run_id == "1" else tuple(WIDE)
                _load(spark, sf_dir, folder, run_id, new_keys=True, open_only=False, loaded=loaded, base=base)
        sales = spark.read.parquet(f"{base}/fact_sales")
        others = [f"{base}/{name}" for name in WIDE if name != "fact_sales"]
        return sales
    finally:
        for path in others:
            remove_folder(spark, path)


QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): query
    for name, query in list(globals().items())
    if name.startswith("q_")
}
