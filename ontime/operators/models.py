"""Training, prediction and tuning with pyspark.ml."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vector
from pyspark.ml.param import Params
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession

from ontime import config
from ontime.operators.encode import FEATURES, feature_names
from ontime.operators.ranking import arg_best

INTERCEPT = -1
# Rows of one task of a forest's fit, which keeps a number per row and slot.
TREE_ROWS = 500_000


def train_logistic(train: DataFrame, **params) -> LogisticRegressionModel:
    """Logistic regression; ``aggregationDepth`` is worth raising on many executors."""
    return LogisticRegression(featuresCol=FEATURES, labelCol="label", **params).fit(train)


def train_forest(
    train: DataFrame, num_trees: int = config.FOREST_TREES, seed: int = config.SEED, **params
) -> RandomForestClassificationModel:
    """Random forest. A compressed file of vectors can hold millions of rows, so beyond
    ``TREE_ROWS`` the rows are dealt out to tasks that read no more than that many each."""
    forest = RandomForestClassifier(
        featuresCol=FEATURES, labelCol="label", numTrees=num_trees, seed=seed, **params
    )
    return forest.fit(deal_out(train.select(FEATURES, "label", *_weight(params))))


def _weight(params: dict) -> list[str]:
    return [params["weightCol"]] if params.get("weightCol") else []


def deal_out(df: DataFrame, rows_per_task: int = TREE_ROWS) -> DataFrame:
    """The rows in even parts of at most about ``rows_per_task``, a part per core at least;
    a table of no more rows than that as it is."""
    rows = df.count()
    if rows <= rows_per_task:
        return df
    return df.repartition(max(-(-rows // rows_per_task), df.sparkSession.sparkContext.defaultParallelism))


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Add rawPrediction, probability and prediction."""
    return model.transform(df)


def with_score(predictions: DataFrame, out: str = "score") -> DataFrame:
    """Add the probability of the positive class as a plain double."""
    return predictions.withColumn(out, vector_to_array("probability")[1])


def _slots(spark: SparkSession, vector: Vector, value: str) -> DataFrame:
    """(idx, value): a model vector as a table; its length is the feature count."""
    rows = [(i, float(x)) for i, x in enumerate(vector.toArray())]
    return spark.createDataFrame(rows, f"idx int, {value} double")


def coefficients(model: LogisticRegressionModel) -> DataFrame:
    """(idx, coefficient) per slot; the intercept has idx -1."""
    spark = SparkSession.active()
    intercept = spark.createDataFrame([(INTERCEPT, float(model.intercept))], "idx int, coefficient double")
    return _slots(spark, model.coefficients, "coefficient").unionByName(intercept)


def named_coefficients(
    model: LogisticRegressionModel, df: DataFrame, features: str = FEATURES
) -> DataFrame:
    """(idx, name, coefficient) per slot, names matched by index."""
    slots = _slots(df.sparkSession, model.coefficients, "coefficient")
    return slots.join(feature_names(df, features), "idx").select("idx", "name", "coefficient")


def named_importances(
    model: RandomForestClassificationModel, df: DataFrame, features: str = FEATURES
) -> DataFrame:
    """(idx, name, importance) per slot; slots no tree uses have 0."""
    slots = _slots(df.sparkSession, model.featureImportances, "importance")
    return slots.join(feature_names(df, features), "idx").select("idx", "name", "importance")


def param_grid(estimator: Params, values: dict[str, Sequence]) -> list[dict]:
    """Every combination of the given values of the estimator's parameters."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), list(options))
    return builder.build()


def param_table(spark: SparkSession, maps: Sequence[dict]) -> DataFrame:
    """(position, params): the grid as a table, parameters as JSON text."""
    rows = [(i, _as_json(m)) for i, m in enumerate(maps)]
    return spark.createDataFrame(rows, "position int, params string")


def _as_json(params: dict) -> str:
    return json.dumps({p.name: v for p, v in params.items()}, sort_keys=True, default=str)


def default_grid(lr: LogisticRegression) -> list[dict]:
    return param_grid(
        lr, {"regParam": config.REG_PARAMS, "elasticNetParam": config.ELASTIC_NET_PARAMS}
    )


def grid_estimator() -> LogisticRegression:
    return LogisticRegression(featuresCol=FEATURES, labelCol="label", maxIter=config.GRID_MAX_ITER)


def grid_scores(search: CrossValidatorModel) -> DataFrame:
    """(position, params, metric): mean metric over the folds per grid point."""
    rows = [
        (i, _as_json(m), float(metric))
        for i, (m, metric) in enumerate(zip(search.getEstimatorParamMaps(), search.avgMetrics))
    ]
    return SparkSession.active().createDataFrame(rows, "position int, params string, metric double")


def best_params(search: CrossValidatorModel) -> DataFrame:
    """The grid point with the highest mean metric."""
    return arg_best(grid_scores(search), "metric", "position")


def model_params(model: Params) -> DataFrame:
    """(param, value): all parameters of a model, defaults included."""
    rows = sorted((p.name, str(v)) for p, v in model.extractParamMap().items())
    return SparkSession.active().createDataFrame(rows, "param string, value string")
