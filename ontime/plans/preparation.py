"""Cleaned to trusted: label, features, split, encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime import config
from ontime.operators import (
    EncodedSplit,
    add_label,
    add_season,
    add_times_of_day,
    assign_parts,
    at_least,
    cast_columns,
    drop_columns,
    drop_nulls,
    fit_features,
    has_values,
    keep_at_least,
    row_count_audit,
)
from ontime.plans.cleaning import CLEANED
from ontime.sources import read_cleaned, read_zone, write_zone

FEATURES = "features"
TRAINING_DATA, TEST_DATA = "trusted/training_data", "trusted/test_data"


def clean_for_model(df: DataFrame) -> DataFrame:
    """Rows fit for learning: complete, with a possible scheduled time, labelled."""
    kept = drop_nulls(drop_columns(df, ["DivAirportLandings"]))
    kept = keep_at_least(kept, "CRSElapsedTime", 0)
    return cast_columns(add_label(kept), config.MODEL_CASTS)


def clean_for_model_audit(df: DataFrame) -> DataFrame:
    """Rows left after each filter of ``clean_for_model``, in one pass."""
    kept = drop_columns(df, ["DivAirportLandings"])
    return row_count_audit(
        kept, {"no_nulls": has_values(kept), "crs_elapsed": at_least(kept, "CRSElapsedTime", 0)}
    )


def add_features(df: DataFrame) -> DataFrame:
    """Times of day and season added, columns that must not be learned dropped."""
    return drop_columns(add_season(add_times_of_day(df)), config.NON_FEATURE_COLUMNS)


def write_features(cleaned: DataFrame, root: str, keys: Sequence[str]) -> str:
    """Write the narrow feature table, one folder per split part.

    The null tests read every column of the cleaned table and the encoding fits
    make several passes, so those passes start from this table instead. Each
    part is its own folder, hence a part's fit never opens the other's files.
    """
    table = assign_parts(add_features(clean_for_model(cleaned)), keys)
    return write_zone(table, root, FEATURES, partition_by=["part"])


def read_parts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The training and the test part of the feature table."""
    table = read_zone(spark, root, FEATURES)
    return tuple(table.filter(F.col("part") == i).drop("part") for i in (0, 1))


def feature_job(spark: SparkSession, root: str, keys: Sequence[str]) -> EncodedSplit:
    """Cleaned zone to the trusted training and test tables."""
    write_features(read_cleaned(spark, f"{root.rstrip('/')}/{CLEANED}"), root, keys)
    encoded = fit_features(*read_parts(spark, root))
    write_zone(encoded.train, root, TRAINING_DATA)
    write_zone(encoded.test, root, TEST_DATA)
    return EncodedSplit(*read_trusted(spark, root), encoded.model)


def read_trusted(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Training and test tables with the label as double, ready for training."""
    return tuple(
        cast_columns(read_zone(spark, root, zone), {"label": "double"})
        for zone in (TRAINING_DATA, TEST_DATA)
    )
