"""Category dictionaries as tables: no list of categories on the driver.

A dictionary numbers the values of each column by falling frequency, equal ones in
byte order, as the string indexer does, however many values there are. Ranks come
from running counts over ranges, so no task holds a column's values. Rows are
numbered by two joins: the first ``HEAD`` values of each column, which hold every hot
value, are broadcast; the rest are joined by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.operators.encode import index_name
from ontime.operators.profile import as_text, cell_counts
from ontime.operators.running import running_totals

# Values of one column that are broadcast. A value that is not among them holds less
# than one row in HEAD of its column.
HEAD = 10_000


def category_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n, idx): the values of each column as text, most frequent
    first, from 0. Nulls and NaN are not categories; an empty table has none."""
    counts = cell_counts(df, cols).filter(F.col("value").isNotNull())
    ordered = counts.select(
        "column", F.struct((-F.col("n")).alias("falling"), "value").alias("place"), F.lit(1).alias("one")
    )
    ranked = running_totals(ordered, "place", ["one"], ["column"])
    return ranked.select(
        "column",
        F.col("place.value").alias("value"),
        (-F.col("place.falling")).alias("n"),
        F.col("one_before").cast("bigint").alias("idx"),
    )


def dictionary_sizes(dictionary: DataFrame) -> dict[str, int]:
    """Number of values per column."""
    return {row["column"]: row["n_values"] for row in dictionary.groupBy("column").agg(F.count("*").alias("n_values")).collect()}


def index_by_dictionary(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], head: int = HEAD) -> DataFrame:
    """``df`` with an index column per column, null and unknown values as the index
    after the last.

    The index columns say how many values they have, so a one-hot encoder needs no
    pass of its own. Rows whose value is among the first ``head`` go to the second
    join with a null key and the number of their task, which spreads them; a column
    of at most ``head`` values has no second join. Hand in a written dictionary: each
    column reads it.
    """
    sizes = dictionary_sizes(dictionary)
    kinds = dict(df.dtypes)
    out = df
    for c in cols:
        size = sizes.get(c, 0)
        index, near, key, far, spread = index_name(c), f"_near_{c}", f"_key_{c}", f"_far_{c}", f"_spread_{c}"
        one = dictionary.filter(F.col("column") == c)
        first = one.filter(F.col("idx") < head).select(F.col("value").alias(key), F.col("idx").alias(near))
        text = as_text(F.col(c), kinds[c])
        # At most ``head`` rows.
        out = out.withColumn(far, text).join(F.broadcast(first), F.col(far) == F.col(key), "left").drop(key, far)
        known = F.col(near)
        if size > head:
            rest = one.filter(F.col("idx") >= head).select(
                F.col("value").alias(key), F.lit(-1).alias(spread), F.col("idx").alias(far)
            )
            open_value = F.col(near).isNull() & text.isNotNull()
            keyed = out.withColumn(key, F.when(open_value, text)).withColumn(
                spread, F.when(open_value, F.lit(-1)).otherwise(F.spark_partition_id())
            )
            out = keyed.join(rest, [key, spread], "left").drop(key, spread)
            known = F.coalesce(known, F.col(far))
        nominal = {"ml_attr": {"type": "nominal", "name": index, "num_vals": size + 1}}
        position = F.coalesce(known, F.lit(size)).cast("double").alias(index, metadata=nominal)
        out = out.select(*[x for x in out.columns if x not in (near, far)], position)
    return out
