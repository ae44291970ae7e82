"""Table profiles in long form: one row per column (and source file)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime import config
from ontime.functions import drop_nan, is_missing, unsigned_zero
from ontime.operators.projection import numeric_columns, type_class
from ontime.operators.quantiles import LEAF, refine, sketch_grid
from ontime.operators.running import percentile_name
from ontime.session import cut_lineage

QUARTILES = (0.25, 0.5, 0.75)
# Row hashes that may be broadcast: 8 bytes each.
FEW = 1_000_000
# Columns from which on a row is wide: eight times the width of its hash.
WIDE = 8
# Microseconds and offset: the default text of a timestamp in JSON has milliseconds only.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _count_columns(df: DataFrame, condition, names: Sequence[str], out: str) -> DataFrame:
    kinds = dict(df.dtypes)
    counted = df.agg(
        *[F.count_if(condition(F.col(c), kinds[c])).alias(f"n_{i}") for i, c in enumerate(names)]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"n_{i}").alias(out)) for i, c in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*rows)))


def non_null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_values): cells that are neither null nor NaN."""
    names = df.columns if cols is None else cols
    return _count_columns(df, lambda c, kind: ~is_missing(c, kind), names, "n_values")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_nulls): null cells; NaN is a value here."""
    names = df.columns if cols is None else cols
    return _count_columns(df, lambda c, kind: c.isNull(), names, "n_nulls")


def columns_with_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Names of the columns that have any null or NaN."""
    names = df.columns if cols is None else cols
    missing = _count_columns(df, is_missing, names, "n_missing")
    return missing.filter("n_missing > 0").select("column")


def any_missing(df: DataFrame) -> Column:
    return reduce(or_, [is_missing(F.col(c), kind) for c, kind in df.dtypes])


def rows_with_nulls(df: DataFrame) -> DataFrame:
    """Number of rows that have any null or NaN."""
    return df.agg(F.count_if(any_missing(df)).alias("n_rows"))


def duplicate_count(
    df: DataFrame, subset: Sequence[str] | None = None, hashed: bool = False, few: int = FEW
) -> DataFrame:
    """Rows beyond the first of each group of equal rows; nulls are equal.

    Rows count as equal by value only. Equal rows collapse before the shuffle, but
    distinct rows travel whole; so of rows of ``WIDE`` columns or more, or of any with
    ``hashed``, the row hashes that occur more than once are found first, 8 bytes per
    distinct row whatever the width of the table. Equal rows have equal hashes, so a
    row whose hash is its own has no equal, and only the others are compared. Should
    more than ``few`` hashes repeat, they are not broadcast and all rows are compared.
    """
    names = df.columns if subset is None else list(subset)
    rows = df.select(*names)
    if hashed or len(names) >= WIDE:
        kinds = dict(df.dtypes)
        flat = [c for c in names if not kinds[c].startswith(config.NESTED_TYPES)]
        marked = rows.select("*", _row_hash(flat).alias("_hash"))
        repeated = marked.groupBy("_hash").agg(F.count("*").alias("n")).filter("n > 1").select("_hash")
        repeated = cut_lineage(repeated)
        if repeated.count() <= few:
            rows = marked.join(F.broadcast(repeated), "_hash", "left_semi").select(*names)
    groups = rows.groupBy(*names).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def _row_hash(names: Sequence[str]) -> Column:
    """64-bit hash of a row. A null leaves the hash as it is, so each null test
    goes in too: otherwise (null, 1) and (1, null) would look the same."""
    parts = [part for c in names for part in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(1), *parts)


def cell_counts(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids, column, value, n) with values as text: the common base of distinct
    counts, bar charts and categorical profiles, for any number of columns.

    Cells collapse to one row per distinct value before the shuffle, so a value
    that fills a third of a column is one row per task.
    """
    kinds = dict(df.dtypes)
    cells = df.select(*ids, *[as_text(F.col(c), kinds[c]).alias(c) for c in cols])
    return (
        cells.unpivot(list(ids), list(cols), "column", "value")
        .groupBy(*ids, "column", "value")
        .agg(F.count("*").alias("n"))
    )


def as_text(column: Column, kind: str) -> Column:
    """A text that differs for different values of the column.

    Timestamps carry their offset, else an hour that the clock shows twice would
    be one value.
    """
    if kind.startswith(config.NESTED_TYPES):
        return F.to_json(column, {"ignoreNullFields": "false", **JSON_TIMES})
    if kind == "timestamp":
        return F.date_format(column, TIMESTAMP_TEXT)
    return unsigned_zero(drop_nan(column, kind), kind).cast("string")


def _numeric_cells(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids, column, value): one row per cell, as double, NaN as null.

    A few aggregates over long rows run in generated code; a few hundred over a
    wide row would leave it.
    """
    kinds = dict(df.dtypes)
    cells = df.select(*ids, *[drop_nan(F.col(c), kinds[c]).cast("double").alias(c) for c in cols])
    return cells.unpivot(list(ids), list(cols), "column", "value")


def numeric_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n) with values as doubles; null and NaN left out."""
    cells = _numeric_cells(df, cols).filter(F.col("value").isNotNull())
    return cells.groupBy("column", "value").agg(F.count("*").alias("n"))


def _moments() -> list[Column]:
    return [
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]


def describe_numeric(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    percentiles: bool | Sequence[float] = True,
    approx: bool = False,
    accuracy: int = 10_000,
    leaf: int = LEAF,
) -> DataFrame:
    """(column, n_values, mean, std, min, percentiles, max), nulls and NaN skipped.

    Exact percentiles are narrowed down from sketches (see ``quantiles``) and run
    right away: one scan for sketches and the other statistics, one that counts the
    values near the wanted ranks. Brackets above ``leaf`` values take further scans.
    ``approx`` takes the percentiles from sketches of the single pass instead.
    """
    names = numeric_columns(df) if cols is None else list(cols)
    probabilities = QUARTILES if percentiles is True else tuple(percentiles or ())
    marks = [percentile_name(p) for p in probabilities]
    # One null cell per column gives every column a line, even in an empty table.
    blank = df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(c) for c in names])
    numbers = _numeric_cells(df, names)
    cells = numbers.unionByName(_numeric_cells(blank, names))
    aggregates = [F.count("value").alias("n_values"), *_moments()]
    order = ["column", "n_values", "mean", "std", "min", *marks, "max"]
    if not probabilities:
        return cells.groupBy("column").agg(*aggregates).select(*order)
    if approx:
        aggregates.append(F.percentile_approx("value", list(probabilities), accuracy).alias("sketch"))
        table = cells.groupBy("column").agg(*aggregates)
        return table.select("*", *[F.col("sketch")[i].alias(m) for i, m in enumerate(marks)]).select(*order)
    # One row per profiled column.
    rows = cells.groupBy("column").agg(*aggregates, sketch_grid("value").alias("grid")).collect()
    found = refine(numbers, {r["column"]: (r["n_values"], r["grid"]) for r in rows}, probabilities, leaf)
    table = [(r["column"], r["n_values"], r["mean"], r["std"], r["min"], *found[r["column"]], r["max"]) for r in rows]
    doubles = ", ".join(f"`{name}` double" for name in order[2:])
    return df.sparkSession.createDataFrame(table, f"column string, n_values bigint, {doubles}")


def profile_numeric(df: DataFrame, source: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Per source file and numeric column: min, max, mean, std and missing cells."""
    names = [c for c in numeric_columns(df) if c != source] if cols is None else list(cols)
    return (
        _numeric_cells(df, names, [source])
        .groupBy(source, "column")
        .agg(*_moments(), F.count_if(F.col("value").isNull()).alias("n_missing"))
    )


def profile_categorical(df: DataFrame, source: str, cols: Sequence[str]) -> DataFrame:
    """Per source file and column: distinct values, min, max and missing cells.

    One scan: the cells are counted per distinct value first, and min and max are
    then taken over the distinct values, in each column's own type and order.
    """
    kinds = dict(df.dtypes)
    cells = cell_counts(df, cols, [source])
    typed: dict[str, list[str]] = {}
    for c in cols:
        typed.setdefault(kinds[c], []).append(c)
    lows, highs = [], []
    for kind, members in typed.items():
        value = F.col("value")
        if kind.startswith(config.NESTED_TYPES):
            value = F.from_json(value, kind, JSON_TIMES) if not kind.startswith("map") else F.lit(None)
        else:
            value = value.try_cast(kind)
        value = F.when(F.col("column").isin(*members), value)
        lows.append(as_text(F.min(value), kind))
        highs.append(as_text(F.max(value), kind))
    return cells.groupBy(source, "column").agg(
        F.count("value").alias("n_distinct"),
        F.coalesce(*lows).alias("min"),
        F.coalesce(*highs).alias("max"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
    )


def profile(df: DataFrame) -> DataFrame:
    """The whole table profile as (metric, column, value); table-level metrics
    carry the column name ``*``."""
    kinds = dict(df.dtypes)
    names = numeric_columns(df)

    counts = df.agg(
        F.count("*").alias("rows"),
        F.count_if(any_missing(df)).alias("incomplete"),
        *[F.count_if(~is_missing(F.col(c), kind)).alias(f"n_{i}") for i, (c, kind) in enumerate(kinds.items())],
    )
    cells = [_metric("rows_with_nulls", "*", F.col("incomplete"))]
    for i, (c, kind) in enumerate(kinds.items()):
        cells.append(_metric("values", c, F.col(f"n_{i}")))
        cells.append(_metric("has_nulls", c, (F.col(f"n_{i}") < F.col("rows")).cast("int")))
        if c in names:
            cells.append(_metric(f"{type_class(kind)}_type", c, F.lit(1)))
    tables = [
        counts.select(F.inline(F.array(*cells))).filter("metric != 'has_nulls' OR value > 0"),
        duplicate_count(df, hashed=True).select(
            F.inline(F.array(_metric("duplicate_rows", "*", F.col("n_duplicates"))))
        ),
    ]
    if names:
        described = describe_numeric(df, names).drop("n_values")
        measures = [m for m in described.columns if m != "column"]
        tables.append(
            described.unpivot(["column"], measures, "metric", "value").select("metric", "column", "value")
        )
    return reduce(DataFrame.unionByName, tables)


def _metric(name: str, column: str, value: Column) -> Column:
    return F.struct(
        F.lit(name).alias("metric"), F.lit(column).alias("column"), value.cast("double").alias("value")
    )


def shape_profile(df: DataFrame) -> DataFrame:
    """(n_columns, n_rows, column, type): the schema with the row count."""
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("type")) for c, k in df.dtypes])
    counted = df.agg(F.count("*").alias("n_rows"))
    return counted.select(F.lit(len(df.columns)).alias("n_columns"), "n_rows", F.inline(rows))


def value_counts(df: DataFrame, col: str, sort: bool = False) -> DataFrame:
    """(col, n): rows per value; ``sort`` orders by the value."""
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    return counts.orderBy(col) if sort else counts


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """Number of distinct values, with null as one of them."""
    return df.select(col).distinct().agg(F.count("*").alias("n_distinct"))


def fill_missing(df: DataFrame, value: float = 0) -> DataFrame:
    """Nulls of numeric columns replaced by ``value``."""
    return df.fillna(value)
