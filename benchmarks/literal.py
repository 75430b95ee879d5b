"""The same results from the library's own builders without any measuring, as a yardstick.

No published numbers exist for this workload, so these stand in: every join left to
Catalyst and AQE, and every sink computing its result anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from starloom.operators.contracts import conform
from starloom.operators.facts import fact_sales
from starloom.operators.joins import declared_join
from starloom.operators.quality import check_foreign_keys, row_counts
from starloom.plans.queries import WIDE
from starloom.plans.standins import source_tables
from starloom.plans.star import build_star
from starloom.sinks.csv_extract import write_csv_extract
from starloom.sources.files import read_csv_extract
from starloom.sources.session import shared_folder


def fact_sales_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = source_tables(spark, sf_dir)
    return fact_sales(s["payment"], s["rental"], s["inventory"], False, declared_join)


def declared_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = build_star(source_tables(spark, sf_dir), False, declared_join, WIDE)
    return check_foreign_keys(star, WIDE)


def write_both_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/literal/{uuid.uuid4().hex}"
    fact = conform(fact_sales_all(spark, sf_dir), WIDE["fact_sales"])
    write_csv_extract(fact, f"{folder}/extract")
    fact.write.parquet(f"{folder}/warehouse")
    sinks = {
        "extract": read_csv_extract(spark, f"{folder}/extract", WIDE["fact_sales"].schema()),
        "warehouse": spark.read.parquet(f"{folder}/warehouse"),
    }
    return row_counts(sinks).withColumnRenamed("table", "sink")


LITERAL = {
    "fact_sales_all": fact_sales_all,
    "write_both_counts": write_both_counts,
    "check_foreign_keys": declared_foreign_keys,
}
