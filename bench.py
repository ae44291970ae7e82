"""Headline timings: one JSON line with wall seconds per query.

Each query runs once to warm up and then three times into a ``noop`` sink; the
median counts. The landing folder is written before and reported as setup, since
a user of the library starts from landing files.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ontime import config
from ontime.operators import (
    feature_pipeline,
    grid_search,
    named_importances,
    train_forest,
    train_logistic,
)
from ontime.plans.flights import ROW_KEY
from ontime.queries import QUERIES, stages

RUNS = 3
SLOW_RUNS = 1
TABLE_QUERIES = [
    "scan_landing",
    "clean_flights",
    "clean_for_model",
    "row_count_audit",
    "label_distribution",
    "features_table",
    "null_counts",
    "duplicate_count",
    "describe_all",
    "profile_numeric",
    "profile_categorical",
    "profile_all",
    "bar_counts_many",
    "scatter_grid",
    "split_train_test",
    "corr_matrix",
    "chi_square_onehot_sql",
    "confusion_pivot",
    "auc_exact",
    "roc_points",
    "string_index",
    "encode_onehot",
    "minmax_scale",
    "chi_square_slots",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def shuffle_bytes(spark: SparkSession) -> int:
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def seconds(run: Callable[[], None]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    only = sys.argv[1:]
    spark = session(cpus)

    timings: dict[str, float] = {}
    shuffled: dict[str, int] = {}
    setup = seconds(lambda: stages.raw(spark, sf_dir))
    timings["feature_job"] = seconds(lambda: stages.trusted(spark, sf_dir))
    train = stages.trusted(spark, sf_dir)[0]

    def table_query(name: str) -> Callable[[], None]:
        return lambda: drain(QUERIES[name](spark, sf_dir))

    runs = {name: table_query(name) for name in TABLE_QUERIES}
    table = stages.feature_table(spark, sf_dir)
    runs["feature_pipeline"] = lambda: drain(feature_pipeline().fit(table).transform(table))
    slow = {
        "train_logistic": lambda: train_logistic(train),
        "train_forest": lambda: drain(named_importances(train_forest(train), train)),
        "grid_search": lambda: grid_search(train, fold_key=[ROW_KEY], parallelism=int(cpus)),
    }
    for name, run in {**runs, **slow}.items():
        if only and name not in only:
            continue
        if name in runs:
            run()
        before = shuffle_bytes(spark)
        times = [seconds(run) for _ in range(RUNS if name in runs else SLOW_RUNS)]
        timings[name] = statistics.median(times)
        shuffled[name] = (shuffle_bytes(spark) - before) // len(times)

    print(
        json.dumps(
            {
                "metric": "headline queries, median warm wall time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in timings.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "rows": stages.raw(spark, sf_dir).count(),
                "columns": len(config.FLIGHT_COLUMNS),
                "cpus": cpus,
                "setup_sec": round(setup, 3),
                "shuffle_bytes": shuffled,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
