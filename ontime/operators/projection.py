"""Column selection and casts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime import config


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exactly these columns; a missing one is an error."""
    return df.select(*names)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """All but these columns; unknown names are ignored."""
    return df.drop(*names)


def cast_columns(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Cast the named columns in place."""
    return df.withColumns({name: F.col(name).cast(target) for name, target in casts.items()})


def cast_where(df: DataFrame, predicate: Callable[[str], bool], target: str) -> DataFrame:
    """Cast every column whose type name satisfies ``predicate``."""
    return cast_columns(df, {name: target for name, kind in df.dtypes if predicate(kind)})


def is_object_type(kind: str) -> bool:
    """Types that a pandas table would hold as Python objects."""
    base = kind.split("<")[0].split("(")[0]
    return base in ("string", "char", "varchar", "binary", "decimal", *config.NESTED_TYPES)


def type_class(kind: str) -> str:
    if kind in config.INTEGER_TYPES:
        return "integer"
    if kind in config.FLOAT_TYPES:
        return "float"
    return "object" if is_object_type(kind) else "other"


def numeric_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if type_class(kind) in ("integer", "float")]


def columns_by_type(df: DataFrame) -> DataFrame:
    """(column, type_class) with classes integer, float, object and other."""
    rows = [(name, type_class(kind)) for name, kind in df.dtypes]
    return df.sparkSession.createDataFrame(rows, "column string, type_class string")
