"""Slot-wise chi-square from sparse and dense vectors, with and without quantile ranges."""

import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from ontime.operators import chi_square, chi_square_named
from ontime.operators.stats import continuous_slots, slot_quantiles
from ontime.queries import stages


def plain_chi_square(values, labels):
    n, total = len(values), 0.0
    kinds, classes = sorted(set(values)), sorted(set(labels))
    for v in kinds:
        row = sum(x == v for x in values)
        for c in classes:
            column = sum(y == c for y in labels)
            seen = sum(x == v and y == c for x, y in zip(values, labels, strict=True))
            total += (seen - row * column / n) ** 2 / (row * column / n)
    return total, (len(kinds) - 1) * (len(classes) - 1)


@pytest.fixture
def mixed(spark):
    """Sparse and dense rows, an empty slot, a null label, negative values."""
    rng = random.Random(1)
    rows = []
    for i in range(300):
        x = [0.0, float(rng.randrange(3)), rng.choice([0.0, -1.5, 2.5]), round(rng.gauss(0, 1), 3), 0.0]
        held = Vectors.sparse(5, {k: v for k, v in enumerate(x) if v}) if i % 2 else Vectors.dense(x)
        rows.append((float(rng.randrange(3)), held))
    table = spark.createDataFrame([*rows, (None, Vectors.dense([1.0] * 5))], schema=stages_schema()).repartition(4)
    return table, [(y, v.toArray().tolist()) for y, v in rows]


def stages_schema():
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T

    return T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])


def test_any_vectors_against_plain_counts(mixed):
    table, rows = mixed
    got = {r["idx"]: (r["statistic"], r["dof"]) for r in chi_square(table).collect()}
    assert set(got) == set(range(5))
    for i in range(5):
        statistic, dof = plain_chi_square([x[i] for _, x in rows], [y for y, _ in rows])
        assert got[i] == (pytest.approx(statistic), dof)
    library = ChiSquareTest.test(table.dropna(), "features", "label", flatten=True).collect()
    for r in library:
        assert got[r["featureIndex"]][0] == pytest.approx(r["statistic"], abs=1e-9)


def test_quantile_ranges_against_plain_counts(mixed):
    table, rows = mixed
    bounds = slot_quantiles(table.dropna(), [3], 4)[3]
    assert len(bounds) == 3 and abs(bounds[1] - np.median([x[3] for _, x in rows])) < 0.05
    got = {r["idx"]: (r["statistic"], r["dof"]) for r in chi_square(table, bins=4, continuous=[3]).collect()}
    place = [sum(b <= x[3] for b in bounds) for _, x in rows]
    statistic, dof = plain_chi_square(place, [y for y, _ in rows])
    assert got[3] == (pytest.approx(statistic), dof) and dof == 6
    plain = {r["idx"]: (r["statistic"], r["dof"]) for r in chi_square(table).collect()}
    assert all(got[i] == plain[i] for i in (0, 1, 2, 4))


def test_twenty_thousand_values_and_measures_by_metadata(spark, sf_dir):
    train = stages.trusted(spark, sf_dir)[0]
    slots = continuous_slots(train)
    assert len(slots) == 2
    exact = {r["idx"]: r for r in chi_square(train).collect()}
    ranged = {r["idx"]: r for r in chi_square(train, bins=10).collect()}
    assert all(ranged[i]["dof"] <= 9 < exact[i]["dof"] for i in slots)
    assert all(ranged[i]["statistic"] == exact[i]["statistic"] for i in exact if i not in slots)
    assert chi_square_named(train, bins=10).count() == len(exact)

    wide = spark.range(40_000).select(
        (F.col("id") % 2).cast("double").alias("label"), F.transform(F.array((F.col("id") / 2).cast("long")), lambda x: x.cast("double")).alias("x")
    )
    from pyspark.ml.functions import array_to_vector

    many = wide.select("label", array_to_vector("x").alias("features"))
    row = chi_square(many).first()
    assert (row["dof"], row["statistic"]) == (19_999, pytest.approx(0, abs=1e-6))
    row = chi_square(many, bins=20, continuous=[0]).first()
    assert row["dof"] == 19


def test_no_rows(spark):
    assert chi_square(spark.createDataFrame([], stages_schema())).count() == 0
    assert chi_square(spark.createDataFrame([], stages_schema()), bins=3, continuous=[0]).count() == 0
