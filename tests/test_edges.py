"""Score ranges, times that print alike, landing files without a column, infinite grid values."""

import math
from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from ontime.operators import roc_points, scatter_grid
from ontime.operators.profile import cell_counts, profile_categorical
from ontime.operators.stats import chi_square, chi_square_tail
from ontime.sources import missing_columns, read_landing


def curve(points):
    rows = points.orderBy(F.desc("threshold"), "fpr", "tpr").collect()
    return [(r["fpr"], r["tpr"]) for r in rows]


@pytest.mark.parametrize("bins", [10, None])
def test_roc_of_any_scores_runs_from_corner_to_corner(spark, bins):
    table = spark.createDataFrame([(2.5, 1), (1.7, 0), (0.2, 1), (-1.0, 0)], "score double, label int")
    assert curve(roc_points(table, bins=bins)) == [(0.0, 0.0), (0.0, 0.5), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_roc_of_equal_and_of_infinite_scores(spark):
    equal = spark.createDataFrame([(3.0, 1), (3.0, 0)], "score double, label int")
    assert curve(roc_points(equal)) == [(0.0, 0.0), (1.0, 1.0)]
    inf = float("inf")
    table = spark.createDataFrame([(inf, 1), (1.0, 1), (0.0, 0), (-inf, 0)], "score double, label int")
    assert curve(roc_points(table, bins=4)) == [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]


@pytest.mark.parametrize("score", [1.5, None, float("nan")])
def test_roc_refuses_scores_it_cannot_place(spark, score):
    table = spark.createDataFrame([(0.5, 1), (0.1, 0), (score, 0)], "score double, label int")
    with pytest.raises(PySparkException, match="scores"):
        roc_points(table, span=(0, 1)).collect()


def test_roc_rows_stay_within_the_bins(spark):
    table = spark.range(5000).select((F.col("id") * 7.5 - 900).alias("score"), (F.col("id") % 2).alias("label"))
    assert roc_points(table, bins=50).count() <= 52


def test_hour_shown_twice_is_two_values(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        moments = [datetime(2025, 11, 2, h, 30, tzinfo=timezone.utc) for h in (5, 6)]
        table = spark.createDataFrame([("f", m) for m in moments], "source string, t timestamp")
        assert cell_counts(table, ["t"]).count() == 2
        row = profile_categorical(table, "source", ["t"]).first()
        assert (row["n_distinct"], row["min"][:19], row["max"][:19]) == (2, "2025-11-02 01:30:00", "2025-11-02 01:30:00")
        assert row["min"] != row["max"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_nested_times_a_microsecond_apart_are_two_values(spark):
    rows = [([datetime(2025, 1, 1, 0, 0, 0, micros)],) for micros in (1, 2)]
    for kind in ("timestamp", "timestamp_ntz"):
        assert cell_counts(spark.createDataFrame(rows, f"t array<{kind}>"), ["t"]).count() == 2


def test_landing_file_without_a_column_is_an_error(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).select("id", F.lit(1).alias("b")).coalesce(1).write.parquet(f"{root}/x")
    spark.range(3).coalesce(1).write.mode("append").parquet(f"{root}/x")
    lacking = missing_columns(spark, f"{root}/x", ["ID", "b"])
    assert list(lacking.values()) == [["b"]]
    with pytest.raises(ValueError, match="lacks b"):
        read_landing(spark, f"{root}/x", schema="id long, b int", required=["id", "b"])
    assert read_landing(spark, f"{root}/x", schema="id long, b int", required=["id"]).count() == 6
    last = min(r["source_file"] for r in read_landing(spark, f"{root}/x").select("source_file").collect())
    expected = 0 if not next(iter(lacking)).endswith(last) else 1
    assert len(missing_columns(spark, f"{root}/x", ["b"], last_file=last)) == expected


def test_infinite_cells_leave_the_grid_as_it_is(spark):
    inf = float("inf")
    table = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (0.5, inf), (0.5, -inf)], "x double, y double")
    cells = {(r["x_bin"], r["y_bin"]): r["n"] for r in scatter_grid(table, "x", ["y"], bins=4).collect()}
    assert cells == {(0, 0): 1, (3, 3): 1, (2, 3): 1, (2, 0): 1}


def test_slot_tests_equal_the_library(spark):
    table = spark.range(4000).select(
        (F.col("id") % 3).cast("double").alias("label"),
        ((F.col("id") * 7919) % 97).cast("double").alias("a"),
        (F.col("id") % 3 == 1).cast("double").alias("b"),
        F.lit(0.0).alias("c"),
        ((F.col("id") * F.col("id")) % 11 - 5).cast("double").alias("d"),
    )
    vectors = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(table)
    own = chi_square(vectors).orderBy("idx").collect()
    library = ChiSquareTest.test(vectors, "features", "label", flatten=True).orderBy("featureIndex").collect()
    assert [r["dof"] for r in own] == [r["degreesOfFreedom"] for r in library]
    for mine, theirs in zip(own, library, strict=True):
        assert math.isclose(mine["statistic"], theirs["statistic"], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(mine["p_value"], theirs["pValue"], rel_tol=1e-8, abs_tol=1e-12)


def test_slot_test_of_many_values(spark):
    table = spark.range(40_000).select(
        (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 20_000).cast("double").alias("a")
    )
    vectors = VectorAssembler(inputCols=["a"], outputCol="features").transform(table)
    row = chi_square(vectors).first()
    # Each value has one label only, so the statistic is the row count.
    assert row["dof"] == 19_999
    assert math.isclose(row["statistic"], 40_000, rel_tol=1e-9)
    assert row["p_value"] < 1e-9


@pytest.mark.parametrize(("statistic", "dof", "expected"), [(3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05), (9.34181776559197, 10, 0.5)])
def test_chi_square_tail(statistic, dof, expected):
    assert math.isclose(chi_square_tail(statistic, dof), expected, rel_tol=1e-9)


def test_slot_tests_of_an_empty_table(spark):
    table = spark.createDataFrame([], "label double, a double")
    vectors = VectorAssembler(inputCols=["a"], outputCol="features").transform(table)
    assert chi_square(vectors).count() == 0
