"""Time the registered queries and print one JSON line.

Each query is built and run to the end (noop sink), so measuring jobs, staging and
writes count too. ``queries`` holds the second of two runs; ``first_run`` the one that
still pays for class loading and code generation. BENCH_SF_DIR and BENCH_CPUS choose
the data and the cores; names as arguments choose queries.

``--literal`` times the plans of ``benchmarks.literal`` instead, beside ours.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from benchmarks.literal import LITERAL
from starloom.plans.queries import QUERIES

Query = Callable[[SparkSession, str], DataFrame]


def seconds(query: Query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    literal = "--literal" in sys.argv
    names = [a for a in sys.argv[1:] if not a.startswith("--")]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("starloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if literal:
        queries = {f"{n}{kind}": q[n] for n in names or LITERAL for kind, q in
                   (("", QUERIES), ("_literal", LITERAL))}
    else:
        queries = {n: QUERIES[n] for n in names or QUERIES}
    first = {name: seconds(query, spark, sf_dir) for name, query in queries.items()}
    second = {name: seconds(query, spark, sf_dir) for name, query in queries.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(second.values()), 3),
                "unit": "sec",
                "queries": second,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
