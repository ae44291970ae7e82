"""Stages shared by the registered queries.

The flight table is written once per session and data folder, as a landing
folder of Parquet files, and the trained objects are kept. This is how the work
is done for real: each job reads the zone that the job before it wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.operators import (
    EncodedSplit,
    fit_features,
    grid_search,
    predict,
    score_linear,
    train_forest,
    train_logistic,
)
from ontime.plans import (
    add_features,
    clean_flights,
    clean_for_model,
    flights,
    read_parts,
    read_trusted,
    write_features,
)
from ontime.plans.flights import ROW_KEY
from ontime.plans.preparation import FEATURES, TEST_DATA, TRAINING_DATA
from ontime.session import compiled_methods, new_folder
from ontime.sources import read_landing, read_zone, write_zone

# A fixed score for checking the evaluation operators without training.
SCORE_WEIGHTS = {
    "ScheduledDepTimeOfDay": 0.21,
    "DistanceGroup": 0.13,
    "CRSElapsedTime": 0.0007,
    "Season": 0.011,
}
SCORE_INTERCEPT = -1.43

_built: dict[tuple, Any] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], Any]) -> Any:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def work_folder(spark: SparkSession, sf_dir: str) -> str:
    """The shared folder that holds this data folder's zones."""
    return _once(spark, sf_dir, "root", lambda: new_folder(spark, "flights"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flight records from the landing folder: 44 columns and RowKey."""

    def land() -> DataFrame:
        # The view's own join deals out the lines as six columns; the 45 are not shuffled.
        view = flights(spark, sf_dir)
        with compiled_methods(spark):
            path = write_zone(view, work_folder(spark, sf_dir), "landing")
        return read_landing(spark, path, schema=view.schema, tag_source=False)

    return _once(spark, sf_dir, "landing", land)


def by_year(df: DataFrame) -> DataFrame:
    """Tag records with the yearly file they would have come in."""
    return df.withColumn("source_file", F.concat(F.lit("flights_"), "Year", F.lit(".parquet")))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "cleaned", lambda: clean_flights(raw(spark, sf_dir), carry=[ROW_KEY])
    )


def model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "model_input", lambda: clean_for_model(cleaned(spark, sf_dir)))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "featured", lambda: add_features(model_input(spark, sf_dir)))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores at 12 decimals: equal ones then tie whatever order the terms were
    added in and whichever platform computed the exponential."""
    table = score_linear(featured(spark, sf_dir), SCORE_WEIGHTS, SCORE_INTERCEPT)
    return table.withColumn("probability", F.round("probability", 12))


def features_root(spark: SparkSession, sf_dir: str) -> str:
    """The folder below which the feature table is written."""
    root = work_folder(spark, sf_dir)
    _once(
        spark, sf_dir, "features",
        lambda: write_features(cleaned(spark, sf_dir), root, [ROW_KEY]),
    )
    return root


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written feature table: the narrow input of every fit."""
    return read_zone(spark, features_root(spark, sf_dir), FEATURES).drop("part")


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test part of the written feature table."""
    return read_parts(spark, features_root(spark, sf_dir))


def encoded(spark: SparkSession, sf_dir: str) -> EncodedSplit:
    return _once(spark, sf_dir, "encoded", lambda: fit_features(*parts(spark, sf_dir)))


def trusted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The written training and test tables, label as double."""
    root = work_folder(spark, sf_dir)

    def write() -> bool:
        split = encoded(spark, sf_dir)
        write_zone(split.train, root, TRAINING_DATA)
        write_zone(split.test, root, TEST_DATA)
        return True

    _once(spark, sf_dir, "trusted", write)
    return read_trusted(spark, root)


def logistic(spark: SparkSession, sf_dir: str):
    return _once(spark, sf_dir, "logistic", lambda: train_logistic(trusted(spark, sf_dir)[0]))


def forest(spark: SparkSession, sf_dir: str):
    return _once(spark, sf_dir, "forest", lambda: train_forest(trusted(spark, sf_dir)[0]))


def search(spark: SparkSession, sf_dir: str):
    """The full 12-point, 3-fold grid search."""
    return _once(
        spark, sf_dir, "search",
        lambda: grid_search(trusted(spark, sf_dir)[0], fold_key=[ROW_KEY], parallelism=8),
    )


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline predictions on the test table."""
    return predict(logistic(spark, sf_dir), trusted(spark, sf_dir)[1])
