"""Seconds per headline query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

The raw tables of the pipelines are written to Parquet first, untimed, so that the
numbers are those of the pipelines reading stored tables. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixtures.queries import QUERIES, SETTINGS  # noqa: E402
from fixtures.raw import SPECS, STORES, rates_frame, raw_frame, source_name  # noqa: E402
from marketloom.plans import run, unify  # noqa: E402
from marketloom.sources import Registry  # noqa: E402

PIPELINES = (
    "m01_buy_box", "m06_inventory", "m10_item", "m12_orders", "m14_promotions",
    "m15_reconciliation", "m18_returns", "m19_returns_order_lines", "m25_unpublished_items",
)
LOADS = ("m12_orders", "m15_reconciliation")
OPERATORS = (
    "join_fx_fanout", "unnest_json_inner", "win_dense_rank_latest",
    "win_dense_rank_hot_keys", "win_row_number_latest", "snk_merge_upsert",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("marketloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    cpus = spark.sparkContext.defaultParallelism
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    registries = {}
    start = time.perf_counter()
    for name in PIPELINES:
        if name == "m19_returns_order_lines":
            registries[name] = registries["m18_returns"]
            continue
        paths = {}
        for brand in STORES:
            path = f"{folder}/{name}/{source_name(name, brand)}"
            raw_frame(spark, sf_dir, name, brand, files=cpus).write.parquet(path)
            paths[source_name(name, brand)] = path
        registries[name] = Registry.from_paths(paths)
    landing = time.perf_counter() - start
    spark.range(1000).selectExpr("sum(id)").collect()

    seconds: dict[str, float] = {}
    for name in PIPELINES:
        rates = rates_frame(spark, sf_dir) if SPECS[name].fx else None

        def pipeline(name=name, rates=rates):
            consume(unify(spark, SPECS[name], registries[name], rates, settings=SETTINGS))

        seconds[name] = timed(pipeline)
    for name in LOADS:
        rates = rates_frame(spark, sf_dir) if SPECS[name].fx else None

        def load(name=name, rates=rates):
            run(spark, SPECS[name], registries[name], f"{folder}/target/{name}", rates, SETTINGS)

        seconds[f"{name}_first_load"] = timed(load)
        seconds[f"{name}_incremental"] = timed(load)
    for name in OPERATORS:
        seconds[name] = timed(lambda name=name: consume(QUERIES[name](spark, sf_dir)))

    print(f"landing {landing:.1f}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
