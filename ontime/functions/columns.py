"""Column expressions. All of them are built-in functions, so they stay inside
whole-stage code generation; none needs a Python worker."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from ontime import config


def hour_from_hhmm(clock: Column) -> Column:
    """Hour of a clock number such as 1345; null for null and NaN."""
    return (clock / 100).try_cast("int")


def time_of_day(clock: Column) -> Column:
    """1 morning, 2 afternoon, 3 evening, 4 night (also for unknown times)."""
    hour = hour_from_hhmm(clock)
    cases = F
    for start, end, code in config.TIME_OF_DAY:
        cases = cases.when((hour >= start) & (hour < end), code)
    return cases.otherwise(config.NIGHT)


def season(month: Column) -> Column:
    """1 winter, 2 spring, 3 summer, 4 fall (also for unknown months)."""
    cases = F
    for months, code in config.SEASONS:
        cases = cases.when(month.isin(*months), code)
    return cases.otherwise(config.FALL)


def late_label(minutes: Column, threshold: float = config.LATE_MINUTES) -> Column:
    """1 if strictly later than ``threshold`` minutes, else 0 (also for null and NaN)."""
    return F.when((minutes > threshold) & ~F.isnan(minutes.cast("double")), 1).otherwise(0)


def is_missing(column: Column, data_type: str) -> Column:
    """Null, or NaN where the type has one."""
    if data_type in config.FLOAT_TYPES:
        return column.isNull() | F.isnan(column)
    return column.isNull()


def drop_nan(column: Column, data_type: str) -> Column:
    """The column with NaN turned into null, so aggregates skip it."""
    if data_type in config.FLOAT_TYPES:
        return F.nanvl(column, F.lit(None).cast(data_type))
    return column


def unsigned_zero(column: Column, data_type: str) -> Column:
    """The column with -0.0 turned into 0.0, so both render as one value."""
    if data_type in config.FLOAT_TYPES:
        return column + F.lit(0.0).cast(data_type)
    return column


def hash_bucket(keys: list[str], seed: int | str, buckets: int) -> Column:
    """Bucket 0..buckets-1 that depends on the key values and the seed only,
    never on how the rows happen to be partitioned."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


# Key hashes are compared as whole numbers of this many bits, never in buckets,
# so shares of any size come out.
HASH_BITS = 60


def key_hash(keys: list[str], seed: int | str) -> Column:
    """A number below 2^60 that depends on the key values and the seed only."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def share_limit(share: float) -> int:
    """The bound below which a share of all key hashes lies."""
    return int(share * (1 << HASH_BITS))


def logistic(weights: dict[str, float], intercept: float) -> Column:
    """Probability from a linear score with the given weights."""
    terms = [F.lit(w) * F.col(c) for c, w in weights.items()]
    score = reduce(add, terms, F.lit(float(intercept)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def zone_path(path: Column, source: str = "landing", target: str = "cleaned") -> Column:
    """The path moved from one zone folder to another."""
    return F.replace(path, F.lit(f"{source}/"), F.lit(f"{target}/"))


def is_parquet(path: Column) -> Column:
    return path.endswith(".parquet")
