"""Train / test split and fixed scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime import config
from ontime.functions import key_hash, logistic, share_limit


def assign_parts(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float] = config.SPLIT_WEIGHTS,
    seed: int = config.SEED,
    out: str = "part",
) -> DataFrame:
    """Add the number of the part each row belongs to.

    It depends on the row's key alone: no shuffle, and the same after any
    repartitioning, retry or rerun.
    """
    hashed = key_hash(list(keys), seed)
    part, passed = F, 0.0
    for number, weight in enumerate(weights[:-1]):
        passed += weight
        part = part.when(hashed < share_limit(passed / sum(weights)), number)
    last = len(weights) - 1
    return df.withColumn(out, part.otherwise(last) if last else F.lit(0))


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float] = config.SPLIT_WEIGHTS,
    seed: int = config.SEED,
) -> list[DataFrame]:
    """Disjoint parts with about the given shares of the rows."""
    tagged = assign_parts(df, keys, weights, seed, "_part")
    return [tagged.filter(F.col("_part") == i).drop("_part") for i in range(len(weights))]


def random_split(
    df: DataFrame, weights: Sequence[float] = config.SPLIT_WEIGHTS, seed: int = config.SEED
) -> list[DataFrame]:
    """Spark's own split, for tables without a key. Its parts change with the
    partitioning, so write them out before using them twice."""
    return df.randomSplit(list(weights), seed)


def score_linear(
    df: DataFrame, weights: dict[str, float], intercept: float = 0.0, threshold: float = 0.5
) -> DataFrame:
    """Add the logistic ``probability`` and 0/1 ``prediction`` of given weights."""
    scored = df.withColumn("probability", logistic(weights, intercept))
    return scored.withColumn("prediction", F.when(F.col("probability") > threshold, 1.0).otherwise(0.0))
