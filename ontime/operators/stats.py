"""Correlation and chi-square tests."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement
from operator import add

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions import drop_nan, unsigned_zero
from ontime.operators.encode import FEATURES, feature_names, vector_name

# A test has a counter per label.
MAX_LABELS = 100
CHI_SQUARE = "idx int, statistic double, p_value double, dof int"


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, r): Pearson correlation of every pair, all in one pass; each pair
    uses the rows where both values are known."""
    kinds = dict(df.dtypes)
    x = {c: drop_nan(F.col(c), kinds[c]).cast("double") for c in cols}
    pairs = list(combinations_with_replacement(cols, 2))
    wide = df.agg(
        *[F.lit(1.0).alias(f"r{i}") if a == b else F.corr(x[a], x[b]).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    )
    cells = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            cells.append(
                F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"), F.col(f"r{i}").alias("r"))
            )
    return wide.select(F.inline(F.array(*cells)))


def corr_matrix_wide(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, r) for many columns, from one covariance matrix instead of an
    aggregate per pair. Rows with a null or NaN in any column are left out."""
    assembler = VectorAssembler(inputCols=list(cols), outputCol="_x", handleInvalid="skip")
    matrix = Correlation.corr(assembler.transform(df).select("_x"), "_x").first()[0].toArray()
    rows = [(a, b, float(matrix[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def label_values(df: DataFrame, label: str) -> list:
    """The labels there are, in order; nulls are no label."""
    found = df.select(label).filter(F.col(label).isNotNull()).distinct().limit(MAX_LABELS + 1).collect()
    if len(found) > MAX_LABELS:
        raise ValueError(f"{label} has more than {MAX_LABELS} values: not a class label")
    return sorted(row[0] for row in found)


def _label_counts(df: DataFrame, cols: Sequence[str], label: str, labels: Sequence[int]) -> DataFrame:
    """(column, category, o0, o1, ...): rows per category and label, with the
    column's own totals n0, n1, ... and n. One shuffle, after partial counts."""
    kinds = dict(df.dtypes)
    cells = df.select(
        F.col(label).alias("_label"),
        *[unsigned_zero(drop_nan(F.col(c), kinds[c]), kinds[c]).cast("string").alias(c) for c in cols],
    )
    observed = (
        cells.filter(F.col("_label").isin(*labels))
        .unpivot(["_label"], list(cols), "column", "category")
        .filter(F.col("category").isNotNull())
        .groupBy("column", "category")
        .agg(*[F.count_if(F.col("_label") == v).alias(f"o{i}") for i, v in enumerate(labels)])
    )
    totals = observed.groupBy("column").agg(
        *[F.sum(f"o{i}").cast("double").alias(f"n{i}") for i in range(len(labels))],
        F.count("*").alias("n_categories"),
    )
    # One row per tested column.
    return observed.join(F.broadcast(totals), "column").withColumn(
        "n", reduce(add, [F.col(f"n{i}") for i in range(len(labels))])
    )


def _cell(observed: Column, row: Column, column: Column, total: Column) -> Column:
    """(o - e)^2 / e of one cell; a label without any rows adds nothing."""
    expected = row * column / total
    return F.when(expected > 0, (observed - expected) * (observed - expected) / expected).otherwise(0.0)


def _row(labels: Sequence[int]) -> Column:
    return reduce(add, [F.col(f"o{i}") for i in range(len(labels))]).cast("double")


def _used_labels(labels: Sequence[int]) -> Column:
    return reduce(add, [(F.col(f"n{i}") > 0).cast("int") for i in range(len(labels))])


def chi_square_table(
    df: DataFrame, cols: Sequence[str], label: str = "label", labels: Sequence[int] | None = None
) -> DataFrame:
    """(column, statistic, dof): independence of each raw column and the label.

    Works from category counts, so a column may have any number of categories.
    """
    labels = label_values(df, label) if labels is None else labels
    counts = _label_counts(df, cols, label, labels)
    cells = reduce(
        add, [_cell(F.col(f"o{i}"), _row(labels), F.col(f"n{i}"), F.col("n")) for i in range(len(labels))]
    )
    dof = (F.max("n_categories") - 1) * (F.max(_used_labels(labels)) - 1)
    return counts.groupBy("column").agg(F.sum(cells).alias("statistic"), dof.cast("int").alias("dof"))


def chi_square_onehot(
    df: DataFrame, cols: Sequence[str], label: str = "label", labels: Sequence[int] | None = None
) -> DataFrame:
    """(feature, statistic, dof): the test of each category's 0/1 slot, from the
    same counts and without building vectors."""
    labels = label_values(df, label) if labels is None else labels
    counts = _label_counts(df, cols, label, labels)
    inside = _row(labels)
    outside = F.col("n") - inside
    cells = []
    for i in range(len(labels)):
        here, whole = F.col(f"o{i}"), F.col(f"n{i}")
        cells.append(_cell(here, inside, whole, F.col("n")))
        cells.append(_cell(whole - here, outside, whole, F.col("n")))
    dof = F.when(outside > 0, _used_labels(labels) - 1).otherwise(0)
    feature = F.concat(F.col("column"), F.lit(vector_name("_")[1:] + "_"), F.col("category"))
    return counts.select(feature.alias("feature"), reduce(add, cells).alias("statistic"), dof.cast("int").alias("dof"))


def slot_cells(vector: Column) -> Column:
    """(idx, value) of the cells of a vector that are not zero. A sparse vector says
    where they are; its zeros are never made."""
    plain = F.unwrap_udt(vector)
    given = F.zip_with(plain["indices"], plain["values"], lambda i, x: F.struct(i.alias("idx"), x.alias("value")))
    every = F.transform(plain["values"], lambda x, i: F.struct(i.alias("idx"), x.alias("value")))
    return F.filter(F.when(plain["type"] == 0, given).otherwise(every), lambda cell: cell["value"] != 0)


def held_cells(vector: Column) -> Column:
    """(idx, value) of all cells that a vector holds, zeros too. The expressions are
    compiled, which functions with a lambda are not."""
    plain = F.unwrap_udt(vector)
    width = F.size(plain["values"])
    places = F.when(plain["type"] == 0, plain["indices"]).when(width > 0, F.sequence(F.lit(0), width - 1))
    return F.arrays_zip(places.alias("idx"), plain["values"].alias("value"))


def continuous_slots(df: DataFrame, features: str = FEATURES) -> list[int]:
    """The slots that hold measures, by the column's metadata."""
    return sorted(row["idx"] for row in feature_names(df, features).filter("kind = 'numeric'").collect())


def slot_quantiles(df: DataFrame, slots: Sequence[int], bins: int, features: str = FEATURES) -> dict[int, list[float]]:
    """The inner bounds of ``bins`` ranges with about as many rows each, per slot,
    equal ones once. One pass; the driver gets ``bins - 1`` numbers per slot."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    values = vector_to_array(features)
    found = df.agg(*[F.percentile_approx(values[i], shares, 100 * bins).alias(str(i)) for i in slots]).first()
    return {i: sorted(set(found[str(i)] or ())) for i in slots}


def chi_square(
    df: DataFrame, features: str = FEATURES, label: str = "label", bins: int | None = None, continuous: Sequence[int] | None = None
) -> DataFrame:
    """(idx, statistic, p_value, dof) per slot of the feature vector.

    Every distinct value of a slot is a category, however many there are. With
    ``bins`` the values of the ``continuous`` slots (by default those of measures)
    fall into that many quantile ranges first: a category per value of a measure
    says little, as each is met a few times. Only the cells that are not zero are
    counted, one row per slot, value and label and task; the zeros of a slot are
    what is missing of the label's rows. The result has one row per slot and is
    brought to the driver for its p values.
    """
    bounds: dict[int, list[float]] = {}
    if bins is not None:
        slots_ = continuous_slots(df, features) if continuous is None else list(continuous)
        bounds = slot_quantiles(df.filter(F.col(label).isNotNull()), slots_, bins, features) if slots_ else {}
    rows = df.select(F.col(label).alias("_label"), F.col(features).alias("_vector")).filter(F.col("_label").isNotNull())
    width = F.max(F.unwrap_udt("_vector")["size"])  # null in a dense vector
    width = F.greatest(width, F.max(F.size(F.unwrap_udt("_vector")["values"]))).alias("width")
    found = rows.groupBy("_label").agg(F.count("*").alias("n"), width).limit(MAX_LABELS + 1).collect()
    if len(found) > MAX_LABELS:
        raise ValueError(f"{label} has more than {MAX_LABELS} values: not a class label")
    found.sort(key=lambda row: row["_label"])
    labels, totals = [row["_label"] for row in found], [row["n"] for row in found]
    n, size = float(sum(totals)), max((row["width"] or 0 for row in found), default=0)
    if not size:
        return df.sparkSession.createDataFrame([], CHI_SQUARE)
    counters = [F.count_if(F.col("_label") == v).alias(f"o{i}") for i, v in enumerate(labels)]

    if bounds:
        values = vector_to_array("_vector")
        ranged = []
        for i, own in bounds.items():
            # Ranges count from 1, so that none of them is taken for the zeros.
            place = reduce(add, [(values[i] >= b).cast("int") for b in own], F.lit(1))
            ranged.append(F.struct(F.lit(i).alias("idx"), place.cast("double").alias("value")))
        others = F.filter(slot_cells(F.col("_vector")), lambda cell: ~cell["idx"].isin(*bounds))
        cells = rows.select("_label", F.inline(F.concat(others, F.array(*ranged))))
    else:
        # The outer form takes the cells once; the other one first asks whether there are any.
        held = rows.select("_label", F.inline_outer(held_cells(F.col("_vector")))).toDF("_label", "idx", "value")
        cells = held.filter(F.col("value") != 0)
    observed = cells.groupBy("idx", "value").agg(*counters)
    used = [(F.col(f"o{i}").cast("double"), total) for i, total in enumerate(totals) if total]

    def terms(parts: Sequence[tuple[Column, int]]) -> Column:
        row = reduce(add, [o for o, _ in parts])
        cell = [_cell(o, row, F.lit(float(total)), F.lit(n)) for o, total in parts]
        return F.when(row > 0, reduce(add, cell)).otherwise(0.0)

    found = observed.groupBy("idx").agg(
        F.sum(terms(used)).alias("statistic"),
        F.count("*").alias("categories"),
        *[F.sum(f"o{i}").alias(f"o{i}") for i in range(len(labels))],
    )
    zeros = [(F.lit(float(total)) - o, total) for o, total in used]
    has_zero = reduce(add, [o for o, _ in zeros]) > 0
    table = found.select(
        "idx",
        (F.col("statistic") + terms(zeros)).alias("statistic"),
        (F.col("categories") + has_zero.cast("int")).alias("categories"),
    )
    by_slot = {row["idx"]: (row["statistic"], row["categories"]) for row in table.collect()}
    out = []
    for i in range(size):
        statistic, categories = by_slot.get(i, (0.0, 1))
        dof = (categories - 1) * (len(used) - 1)
        out.append((i, statistic if dof else 0.0, chi_square_tail(statistic, dof), dof))
    return df.sparkSession.createDataFrame(out, CHI_SQUARE)


def chi_square_tail(statistic: float, dof: int) -> float:
    """Probability of a larger chi-square value by chance; one without freedom.

    The upper incomplete gamma function at dof / 2, by its series below the
    mean and by its continued fraction above.
    """
    if dof == 0 or statistic <= 0:
        return 1.0
    a, x = dof / 2, statistic / 2
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while term > total * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1 - scale * total)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    fraction, step, k = d, 0.0, 0
    while abs(step - 1) > 1e-15:
        k += 1
        factor = -k * (k - a)
        b += 2
        d = 1 / ((factor * d + b) or tiny)
        c = (b + factor / c) or tiny
        step = d * c
        fraction *= step
    return scale * fraction


def chi_square_named(df: DataFrame, features: str = FEATURES, label: str = "label", bins: int | None = None) -> DataFrame:
    """``chi_square`` with slot names matched by index, largest statistic first."""
    # One row per vector slot on both sides.
    named = chi_square(df, features, label, bins).join(feature_names(df, features), "idx")
    return named.select("idx", F.col("name").alias("feature"), "statistic", "p_value", "dof").orderBy(
        F.desc("statistic"), "feature"
    )
