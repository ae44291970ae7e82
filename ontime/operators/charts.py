"""The tables behind the figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions import drop_nan
from ontime.operators.profile import cell_counts, value_counts


def bar_counts(df: DataFrame, col: str) -> DataFrame:
    """One bar per value, in value order."""
    return value_counts(df, col, sort=True)


def bar_counts_many(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n) bars of several columns; missing cells have no bar."""
    return cell_counts(df, cols).filter(F.col("value").isNotNull())


def histogram_unit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, bin, n) with bins one unit wide, centred on the integers."""
    kinds = dict(df.dtypes)
    bins = df.select(
        *[F.floor(drop_nan(F.col(c), kinds[c]) + 0.5).cast("bigint").alias(c) for c in cols]
    )
    return (
        bins.unpivot([], list(cols), "column", "bin")
        .filter(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count("*").alias("n"))
    )


def scatter_grid(df: DataFrame, x: str, ys: Sequence[str], bins: int = 50) -> DataFrame:
    """(y, x_bin, y_bin, n): each column against ``x`` on a bins x bins grid.

    The grid spans the exact minimum and maximum of each column, found in one
    pass that brings one row to the driver. Infinite values do not widen it; they
    fall in the outer bins. The result has at most ``len(ys) * bins ** 2`` rows,
    whatever the input.
    """
    kinds = dict(df.dtypes)
    names = [x, *ys]
    clean = df.select(*[drop_nan(F.col(c), kinds[c]).cast("double").alias(c) for c in names])
    finite = {c: F.when(F.abs(c) < float("inf"), F.col(c)) for c in names}
    bounds = clean.agg(
        *[F.min(finite[c]).alias(f"lo_{i}") for i, c in enumerate(names)],
        *[F.max(finite[c]).alias(f"hi_{i}") for i, c in enumerate(names)],
    ).first()

    def grid_bin(i: int) -> Column:
        low, high = bounds[f"lo_{i}"], bounds[f"hi_{i}"]
        value = F.col(names[i])
        if low is None or low == high:
            return F.when(value.isNotNull(), 0)
        inside = F.least(F.greatest(value, F.lit(low)), F.lit(high))
        step = F.floor((inside - F.lit(low)) * F.lit(float(bins)) / F.lit(high - low))
        return F.when(value.isNotNull(), F.least(step, F.lit(bins - 1))).cast("int")

    cells = clean.select(
        grid_bin(0).alias("x_bin"), *[grid_bin(i).alias(c) for i, c in enumerate(names) if i > 0]
    )
    return (
        cells.filter(F.col("x_bin").isNotNull())
        .unpivot(["x_bin"], list(ys), "y", "y_bin")
        .filter(F.col("y_bin").isNotNull())
        .groupBy("y", "x_bin", "y_bin")
        .agg(F.count("*").alias("n"))
    )


def heatmap_long(matrix: DataFrame, row: str, cols: Sequence[str]) -> DataFrame:
    """A matrix with one line per ``row`` as (row, column, value) cells."""
    return matrix.select(
        F.col(row).cast("string").alias("row"), *[F.col(c).cast("double").alias(c) for c in cols]
    ).unpivot(["row"], list(cols), "column", "value")


def roc_chart(points: DataFrame) -> DataFrame:
    """ROC points as chart coordinates."""
    return points.select(F.col("fpr").alias("x"), F.col("tpr").alias("y"), "threshold")
