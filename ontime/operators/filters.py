"""Row filters, row counts and sampling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime import config
from ontime.functions import is_missing, key_hash, share_limit


def has_values(df: DataFrame, subset: Sequence[str] | None = None) -> Column:
    """True where none of the columns is null or NaN.

    One null test per column: these reach the Parquet reader, while a
    "fewer than n nulls" test over all columns does not.
    """
    kinds = dict(df.dtypes)
    names = df.columns if subset is None else subset
    return reduce(and_, [~is_missing(F.col(n), kinds[n]) for n in names], F.lit(True))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without null or NaN in the columns (default: in any column)."""
    return df.filter(has_values(df, subset))


def at_least(df: DataFrame, name: str, minimum: float) -> Column:
    """``name >= minimum``, with NaN counted as false."""
    kept = F.col(name) >= minimum
    if dict(df.dtypes)[name] in config.FLOAT_TYPES:
        kept = kept & ~F.isnan(name)
    return kept


def keep_at_least(df: DataFrame, name: str, minimum: float) -> DataFrame:
    return df.filter(at_least(df, name, minimum))


def count_where(df: DataFrame, condition: Column, alias: str = "n") -> DataFrame:
    return df.agg(F.count_if(condition).alias(alias))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def row_count_audit(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """Rows left after each of the successive filters, in one pass.

    Returns (position, step, n_rows), starting with the unfiltered count.
    """
    passed = F.lit(True)
    counters = [F.count("*").alias("s0")]
    for position, condition in enumerate(steps.values(), start=1):
        passed = passed & condition
        counters.append(F.count_if(passed).alias(f"s{position}"))
    names = ["all", *steps]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(n).alias("step"), F.col(f"s{i}").alias("n_rows")
            )
            for i, n in enumerate(names)
        ]
    )
    return df.agg(*counters).select(F.inline(rows))


def sample_rows(
    df: DataFrame,
    fraction: float,
    seed: int = config.SEED,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Bernoulli sample. With a key the choice depends on its value only, so it
    is the same after any repartitioning; without one Spark draws per partition."""
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.filter(key_hash(list(key), seed) < share_limit(fraction))
