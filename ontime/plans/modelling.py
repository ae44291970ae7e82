"""Trusted to models: baseline, tuned and forest classifiers compared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ontime.operators import (
    compare_fitted,
    grid_search,
    train_forest,
    train_logistic,
)
from ontime.plans.preparation import read_trusted
from ontime.sources import save_model


def model_job(
    spark: SparkSession,
    root: str,
    fold_key: Sequence[str] | None = None,
    grid: list[dict] | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Train the three classifiers, save them below ``models/`` and compare
    them on the test table."""
    train, test = read_trusted(spark, root)
    models = {
        "logistic_regression_model": train_logistic(train),
        "best_lr_model": grid_search(
            train, grid=grid, fold_key=fold_key, parallelism=parallelism
        ).bestModel,
        "random_forest_model": train_forest(train),
    }
    for name, model in models.items():
        save_model(model, f"{root.rstrip('/')}/models/{name}")
    return compare_fitted(models, test)
