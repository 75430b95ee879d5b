"""The whole star: sources to eight conformed tables, checked and loaded."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.contracts import CONTRACTS, Contract, conform
from starloom.operators.dimensions import (
    date_dim,
    dim_customer,
    dim_movie,
    dim_staff,
    dim_store,
    flatten_geography,
)
from starloom.operators.facts import fact_sales
from starloom.operators.joins import Join, ProbedJoin, Size, declared_join, lookup_sizes
from starloom.operators.quality import CheckFailed, check_all, require_clean, require_not_empty
from starloom.sinks.csv_extract import run_path, write_csv_extract
from starloom.sinks.load import append_new_keys, preview, require_loaded, stage
from starloom.sources.session import remove_folder

T = TypeVar("T")
#: (source table, growing key column) -> the largest key now, None for an empty table
Highest = Callable[[str, str], object]

# The source columns that the eight targets need.
SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    "payment": ("payment_id", "customer_id", "staff_id", "rental_id", "amount", "payment_date"),
    "rental": ("rental_id", "inventory_id", "rental_date", "return_date"),
    "inventory": ("inventory_id", "store_id", "film_id"),
    "customer": (
        "customer_id",
        "address_id",
        "first_name",
        "last_name",
        "email",
        "active",
        "create_date",
    ),
    "staff": ("staff_id", "address_id", "first_name", "last_name", "email", "active"),
    "store": ("store_id", "manager_staff_id", "address_id"),
    "address": (
        "address_id",
        "city_id",
        "address",
        "address2",
        "district",
        "postal_code",
        "phone",
    ),
    "city": ("city_id", "country_id", "city"),
    "country": ("country_id", "country"),
    "film": (
        "film_id",
        "language_id",
        "title",
        "description",
        "release_year",
        "rental_duration",
        "rental_rate",
        "length",
        "rating",
        "special_features",
    ),
    "language": ("language_id", "name"),
    "film_category": ("film_id", "category_id"),
    "category": ("category_id", "name"),
}

# The dimensions that hold an address.
LOCATED = ("dim_customer", "dim_staff", "dim_store")


def build_star(
    sources: Mapping[str, DataFrame],
    open_only: bool = True,
    join: Join = declared_join,
    contracts: Mapping[str, Contract] = CONTRACTS,
    geography: DataFrame | None = None,
    only: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """The conformed tables in load order: date and entity dimensions, then the fact.

    ``only`` names those that are wanted; nothing is done for the others.
    """
    s = sources
    wanted = _chosen(only)
    if geography is None and not wanted.isdisjoint(LOCATED):
        geography = flatten_geography(s["address"], s["city"], s["country"], join)
    builders = {
        "dim_payment_date": lambda: date_dim(s["payment"], "payment_date"),
        "dim_rental_date": lambda: date_dim(s["rental"], "rental_date"),
        "dim_return_date": lambda: date_dim(s["rental"], "return_date"),
        "dim_customer": lambda: dim_customer(s["customer"], geography, join),
        "dim_movie": lambda: dim_movie(
            s["film"], s["language"], s["film_category"], s["category"], join
        ),
        "dim_staff": lambda: dim_staff(s["staff"], geography, join),
        "dim_store": lambda: dim_store(s["store"], s["staff"], geography, join),
        "fact_sales": lambda: fact_sales(
            s["payment"],
            s["rental"],
            s["inventory"],
            open_only,
            join,
        ),
    }
    return {name: conform(build(), contracts[name]) for name, build in builders.items() if name in wanted}


def star_sizes(sources: Mapping[str, DataFrame], only: Collection[str] | None = None, open_only: bool = True) -> dict[str, Size]:
    """Proven sizes of the lookups of the star, or of the tables in ``only``, by the names that builders give them.

    The source tables behind them are scanned once, in one job; what a join of them can hold
    follows from their rows, bytes and rows per key, so no join is run to be measured.
    """
    wanted = _chosen(only)
    table = lambda name: sources[name].select(*SOURCE_COLUMNS[name])
    lookups: dict[str, tuple[DataFrame, str]] = {}
    if not wanted.isdisjoint(LOCATED):
        lookups |= {name: (table(name), f"{name}_id") for name in ("country", "city", "address")}
    if "dim_store" in wanted:
        lookups["managers"] = (sources["staff"].select("staff_id", "first_name", "last_name"), "staff_id")
    if "dim_movie" in wanted:
        lookups |= {name: (table(name), f"{name}_id") for name in ("language", "category", "film")}
    if "fact_sales" in wanted:
        rental = table("rental").where(F.col("return_date").isNull()) if open_only else table("rental")
        lookups |= {"items": (table("inventory"), "inventory_id"), "rental": (rental, "rental_id")}
    sizes = lookup_sizes(lookups)
    if "country" in sizes:
        sizes["places"] = sizes["city"].looked_up(sizes["country"])
        sizes["geography"] = sizes["address"].looked_up(sizes["places"])
    if "film" in sizes:
        sizes["films"] = sizes["film"].looked_up(sizes["language"])
    if "rental" in sizes:
        sizes["rented"] = sizes["rental"].looked_up(sizes["items"])
    return sizes


# The growing key of each source, a table before those that it refers to.
CUT_KEYS: dict[str, str] = {
    "payment": "payment_id",
    "rental": "rental_id",
    "inventory": "inventory_id",
    "store": "store_id",
    "staff": "staff_id",
    "customer": "customer_id",
    "film_category": "film_id",
    "film": "film_id",
    "category": "category_id",
    "language": "language_id",
    "address": "address_id",
    "city": "city_id",
    "country": "country_id",
}


def take_cut(highest: Highest) -> dict[str, object]:
    """The largest key of every source, asked for in an order that leaves no reference open.

    Rows are inserted after those that they refer to. So a table asked for later has at least the
    rows that the earlier ones refer to, and what arrives during the load is left to the next.
    """
    return {name: highest(name, key) for name, key in CUT_KEYS.items()}


def within_cut(sources: Mapping[str, DataFrame], cut: Mapping[str, object]) -> dict[str, DataFrame]:
    """The sources up to a cut; the filter is pushed into each read. Rows changed since are seen as they are now."""
    return {
        name: sources[name].where(F.lit(False) if cut[name] is None else F.col(key) <= F.lit(cut[name]))
        for name, key in CUT_KEYS.items()
    }


def _kept_cut(spark: SparkSession, path: str, highest: Highest) -> dict[str, object]:
    """The cut of a run, taken by its first attempt and read by the others."""
    try:
        rows = spark.read.parquet(path).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    if not rows:
        taken = take_cut(highest)
        schema = ", ".join(f"{name} {'string' if isinstance(key, str) else 'bigint'}" for name, key in taken.items())
        spark.createDataFrame([tuple(taken.values())], schema).write.mode("overwrite").parquet(path)
        return taken
    return rows[0].asDict()


def _chosen(only: Collection[str] | None) -> set[str]:
    if unknown := set(only or ()) - set(CONTRACTS):
        raise ValueError(f"no such table: {', '.join(sorted(unknown))}")
    return set(CONTRACTS if only is None else only)


def land_sources(sources: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Copy the needed columns of each source once into the shared folder.

    A database is then read once per table and run, and all eight targets see the
    same rows. Sources that are files already need no landing.
    """
    return _stage_all(
        {name: sources[name].select(*columns) for name, columns in SOURCE_COLUMNS.items()}, folder
    )


def load_star(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    run_id: str,
    folder: str,
    extract_base: str,
    warehouse: Callable[[str, DataFrame], None],
    open_only: bool = True,
    land: bool = True,
    strict: bool = False,
    contracts: Mapping[str, Contract] = CONTRACTS,
    only: Collection[str] | None = None,
    read_back: Callable[[str], DataFrame | None] | None = None,
    new_keys: bool = False,
    lossless: bool = False,
    preview_rows: int = 0,
    create: Callable[[Contract], None] | None = None,
    highest: Highest | None = None,
    keep_work: bool = False,
    compression: str | None = "gzip",
) -> dict[str, DataFrame]:
    """Build, check and load the star, or the tables in ``only``; the staged tables come back.

    Every table is staged in ``folder`` first. The extracts and the warehouse are
    written only after the checks: no table may be empty, and with ``strict`` no
    declared constraint may be broken. ``preview_rows`` shows that many rows of each.

    ``read_back`` reads a table of the warehouse (None if it is not there yet). With it each
    table is checked after its load, and ``new_keys`` appends only rows of keys that the
    warehouse lacks.

    The same ``run_id`` may be repeated after a failure: extracts are replaced, and tables
    that were loaded to the end are not appended again. A table whose append broke off
    half-way is appended again, so use ``new_keys`` where a sink can leave part of one.

    ``create`` makes a target that is not there yet; it is called before any table is loaded,
    a referenced one first. ``highest`` tells the largest key of a source: with it a cut is
    taken once a run, see ``take_cut``, so tables that grow while they are read fit each other.
    Of the run's folder only the staged tables and marks stay once it has succeeded, unless
    ``keep_work``. Extracts are compressed, as text they are several times the tables they
    hold; None for ``compression`` leaves them plain.
    """
    if new_keys and read_back is None:
        raise ValueError("new_keys needs read_back")
    work = f"{folder.rstrip('/')}/star/{run_id}"
    if highest is not None:
        sources = within_cut(sources, _kept_cut(spark, f"{work}/cut", highest))
    if land:
        sources = land_sources(sources, f"{work}/sources")
    join = ProbedJoin(sizes=star_sizes(sources, only, open_only))
    geography = None
    if not _chosen(only).isdisjoint(LOCATED):
        geography = stage(
            flatten_geography(sources["address"], sources["city"], sources["country"], join),
            f"{work}/geography",
        )
    tables = build_star(sources, open_only, join, contracts, geography, only)
    staged = _stage_all(tables, f"{work}/tables")
    require_not_empty(staged)
    if strict:
        require_clean(check_all(staged, contracts))
    if create is not None:
        for name in contracts:
            if name in staged:
                create(contracts[name])

    def load(name: str) -> None:
        if preview_rows:
            preview(staged[name], preview_rows)
        write_csv_extract(staged[name], run_path(extract_base, name, run_id), lossless, replace=True, compression=compression)
        done = f"{work}/loaded/{name}"
        if not _exists(spark, done):
            existing = read_back(name) if new_keys else None
            if existing is None:
                warehouse(name, staged[name])
            else:
                append_new_keys(staged[name], existing, contracts[name].key, lambda df: warehouse(name, df))
            spark.range(1).write.mode("overwrite").parquet(done)
        if read_back is not None:
            loaded = read_back(name)
            if loaded is None:
                raise CheckFailed(f"table {name} is not in the warehouse after the load")
            require_loaded(name, staged[name], loaded, contracts[name].key)

    # the fact refers to the dimensions, which do not refer to each other
    _side_by_side(load, [name for name in staged if name != "fact_sales"])
    if "fact_sales" in staged:
        load("fact_sales")
    if not keep_work:
        for used in ("sources", "geography"):
            remove_folder(spark, f"{work}/{used}")
    return staged


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a mark was written to the end."""
    try:
        return not spark.read.schema("id bigint").parquet(path).isEmpty()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def _stage_all(frames: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    names = list(frames)
    staged = _side_by_side(lambda name: stage(frames[name], f"{folder}/{name}"), names)
    return dict(zip(names, staged))


def _side_by_side(work: Callable[[str], T], names: Sequence[str], at_once: int = 4) -> list[T]:
    """Run independent jobs together, so that small ones fill the gaps of large ones."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(work, names))
