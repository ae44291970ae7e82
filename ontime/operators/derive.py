"""Derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime import config
from ontime.functions import late_label, season, time_of_day


def add_label(
    df: DataFrame,
    minutes: str = "ArrDelayMinutes",
    threshold: float = config.LATE_MINUTES,
    out: str = "label",
) -> DataFrame:
    return df.withColumn(out, late_label(F.col(minutes), threshold))


def add_time_of_day(df: DataFrame, time_col: str, out: str) -> DataFrame:
    return df.withColumn(out, time_of_day(F.col(time_col)))


def add_times_of_day(df: DataFrame, pairs: dict[str, str] | None = None) -> DataFrame:
    """Replace clock columns by their time of day, all in one projection."""
    pairs = config.TIME_COLUMNS if pairs is None else pairs
    return df.withColumns({out: time_of_day(F.col(src)) for src, out in pairs.items()}).drop(*pairs)


def add_season(df: DataFrame, month_col: str = "Month", out: str = "Season") -> DataFrame:
    return df.withColumn(out, season(F.col(month_col)))
