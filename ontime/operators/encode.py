"""Category encoding, scaling and the feature vector."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame

from ontime import config

FEATURES = "features"


def index_name(column: str) -> str:
    return f"{column}Index"


def vector_name(column: str) -> str:
    return f"{column}Vector"


def scaled_name(column: str) -> str:
    return f"{column}Scaled"


def string_indexer(cols: Sequence[str]) -> StringIndexer:
    """Category to index by falling frequency; unseen values get an extra index."""
    return StringIndexer(
        inputCols=list(cols), outputCols=[index_name(c) for c in cols], handleInvalid="keep"
    )


def one_hot(string_cols: Sequence[str], integer_cols: Sequence[str]) -> OneHotEncoder:
    """Sparse 0/1 vectors of the indexed and the integer categories."""
    return OneHotEncoder(
        inputCols=[*map(index_name, string_cols), *integer_cols],
        outputCols=[vector_name(c) for c in [*string_cols, *integer_cols]],
        dropLast=True,
        handleInvalid="keep",
    )


def min_max(cols: Sequence[str]) -> list[VectorAssembler | MinMaxScaler]:
    """Stages that scale each column to [0, 1] by its own minimum and maximum."""
    assemblers = [VectorAssembler(inputCols=[c], outputCol=vector_name(c)) for c in cols]
    scalers = [MinMaxScaler(inputCol=vector_name(c), outputCol=scaled_name(c)) for c in cols]
    return [*assemblers, *scalers]


def feature_pipeline(
    string_cols: Sequence[str] = config.STRING_CATEGORIES,
    integer_cols: Sequence[str] = config.INTEGER_CATEGORIES,
    continuous_cols: Sequence[str] = config.CONTINUOUS_COLUMNS,
) -> Pipeline:
    """Index, encode, scale and assemble into ``features``."""
    encoded = [vector_name(c) for c in [*string_cols, *integer_cols]]
    scaled = [scaled_name(c) for c in continuous_cols]
    return Pipeline(
        stages=[
            string_indexer(string_cols),
            one_hot(string_cols, integer_cols),
            *min_max(continuous_cols),
            VectorAssembler(inputCols=[*encoded, *scaled], outputCol=FEATURES),
        ]
    )


def trim_raw(
    df: DataFrame,
    string_cols: Sequence[str] = config.STRING_CATEGORIES,
    integer_cols: Sequence[str] = config.INTEGER_CATEGORIES,
    continuous_cols: Sequence[str] = config.CONTINUOUS_COLUMNS,
    others: Sequence[str] = config.UNENCODED_COLUMNS,
) -> DataFrame:
    """Drop the raw and intermediate columns that the vectors replace."""
    return df.drop(
        *string_cols,
        *map(index_name, string_cols),
        *integer_cols,
        *continuous_cols,
        *map(vector_name, continuous_cols),
        *others,
    )


class EncodedSplit(NamedTuple):
    train: DataFrame
    test: DataFrame
    model: PipelineModel


def fit_features(train: DataFrame, test: DataFrame, pipeline: Pipeline | None = None) -> EncodedSplit:
    """Fit the encoding on the training part only and apply it to both parts.

    Every estimator of the pipeline makes its own pass over its own columns of
    ``train``: hand in a written table rather than a long plan.
    """
    model = (pipeline or feature_pipeline()).fit(train)
    return EncodedSplit(trim_raw(model.transform(train)), trim_raw(model.transform(test)), model)


def vector_width(df: DataFrame, vector: str) -> int:
    """Number of slots of a vector column, from metadata."""
    return df.schema[vector].metadata["ml_attr"]["num_attrs"]


def feature_names(df: DataFrame, features: str = FEATURES) -> DataFrame:
    """(idx, kind, name) per slot of the vector, in slot order, from metadata."""
    groups = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], kind, a["name"]) for kind, attrs in groups.items() for a in attrs)
    return df.sparkSession.createDataFrame(slots, "idx int, kind string, name string")
