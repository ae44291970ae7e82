"""Column sketches that are kept per source file and merged for any set of files.

A sketch row has the counts, bounds, sum, a quantile sketch (KLL) and a distinct
sketch (HLL) of one column of one file. All of them merge, so the profile of many
files is made of their rows alone, without a look at the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions import drop_nan
from ontime.operators.profile import QUARTILES, as_text
from ontime.operators.running import percentile_name

# Ranks are off by some 0.2 % of the rows, also after merging.
KLL_K = 2048
# 2^HLL_LG registers: distinct counts are off by some 1.6 % (one deviation).
HLL_LG = 12
SKETCHES = (
    "column string, kind string, n_rows bigint, n_values bigint, low double, high double, "
    "total double, low_text string, high_text string, quantiles binary, distinct binary"
)


def column_sketches(df: DataFrame, by: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """One row per (``by``, column) in the layout of ``SKETCHES``; one scan.

    Rows stay rows: a file is one group with the sketches of all its columns, so a
    task looks a row's group up once and holds one set of sketches per file it reads,
    and only those are shuffled. (A group per column would be many more than the
    aggregate keeps before it sorts its input instead, 44 times the rows here.) A
    column without values has null sketches.
    """
    kinds = dict(df.dtypes)
    numbers = [drop_nan(F.col(c), kinds[c]).cast("double").alias(f"value{i}") for i, c in enumerate(numeric)]
    texts = [as_text(F.col(c), kinds[c]).alias(f"text{i}") for i, c in enumerate([*numeric, *categorical])]

    def cell(i: int, c: str) -> Column:
        value, text = F.col(f"value{i}"), F.col(f"text{i}")
        number, none = i < len(numeric), F.lit(None)
        parts = {
            "column": F.lit(c),
            "kind": F.lit("number" if number else "text"),
            "n_rows": F.count("*"),
            "n_values": F.count(text),
            "low": F.min(value) if number else none.cast("double"),
            "high": F.max(value) if number else none.cast("double"),
            "total": F.sum(value) if number else none.cast("double"),
            "low_text": none.cast("string") if number else F.min(text),
            "high_text": none.cast("string") if number else F.max(text),
            "quantiles": F.when(F.count(value) > 0, F.kll_sketch_agg_double(value, KLL_K)) if number else none.cast("binary"),
            "distinct": F.when(F.count(text) > 0, F.hll_sketch_agg(text, HLL_LG)),
        }
        return F.struct(*[part.alias(name) for name, part in parts.items()])

    rows = df.select(F.col(by).alias("file"), *numbers, *texts)
    cells = [cell(i, c) for i, c in enumerate([*numeric, *categorical])]
    return rows.groupBy("file").agg(F.array(*cells).alias("cells")).select(F.col("file").alias(by), F.inline("cells"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketch rows of many files as one row per (``by``, column), same layout."""
    return sketches.groupBy(*by, "column", "kind").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("total").alias("total"),
        F.min("low_text").alias("low_text"),
        F.max("high_text").alias("high_text"),
        F.when(F.count("quantiles") > 0, F.kll_merge_agg_double("quantiles", KLL_K)).alias("quantiles"),
        F.when(F.count("distinct") > 0, F.hll_union_agg("distinct")).alias("distinct"),
    )


def sketched_profile(sketches: DataFrame, by: Sequence[str] = (), probabilities: Sequence[float] = QUARTILES) -> DataFrame:
    """(by, column, kind, n_rows, n_values, n_distinct, min, max, mean, percentiles) of
    merged sketch rows. Counts, bounds and mean are exact, distinct counts and
    percentiles estimates; the percentiles are values of the column."""
    marks = [
        F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p))).alias(percentile_name(p)) for p in probabilities
    ]
    return merge_sketches(sketches, by).select(
        *by, "column", "kind", "n_rows", "n_values",
        F.coalesce(F.hll_sketch_estimate("distinct"), F.lit(0)).cast("bigint").alias("n_distinct"),
        F.col("low").alias("min"), F.col("high").alias("max"),
        F.col("low_text").alias("min_text"), F.col("high_text").alias("max_text"),
        F.when(F.col("n_values") > 0, F.col("total") / F.col("n_values")).alias("mean"),
        *marks,
    )
