"""Shares of any size, and labels that are not silently lost."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from ontime.functions import late_label
from ontime.operators import auc_exact, classification_metrics, confusion_matrix, sample_rows
from ontime.operators.split import assign_parts
from ontime.operators.stats import chi_square_table


@pytest.fixture(scope="module")
def many(spark):
    return spark.range(0, 2_000_000, 1, 8)


@pytest.mark.parametrize("share", [1e-5, 4e-5, 1.6e-4, 1e-4])
def test_small_shares_give_rows(many, share):
    expected = share * 2_000_000
    spread = 5 * math.sqrt(expected)
    sampled = sample_rows(many, share, key=["id"]).count()
    part = assign_parts(many, ["id"], [1 - share, share]).filter("part = 1").count()
    assert abs(sampled - expected) <= spread
    assert abs(part - expected) <= spread


def test_unknown_delay_is_not_late(spark):
    rows = spark.createDataFrame([(float("nan"),), (None,), (6.0,), (5.0,)], "x double")
    assert [r[0] for r in rows.select(late_label(F.col("x"))).collect()] == [0, 0, 1, 0]


@pytest.mark.parametrize("rows", [[(2.0, 1.0)], [(1.0, 2.0)], [(None, 1.0)], [(1.0, None)]])
def test_foreign_labels_are_errors(spark, rows):
    table = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), *rows], "label double, prediction double")
    for measure in (confusion_matrix, classification_metrics):
        with pytest.raises(PySparkException, match="0 or 1"):
            measure(table).collect()


@pytest.mark.parametrize("row", [(2.0, 0.5), (1.0, None)])
def test_area_needs_known_scores_and_labels(spark, row):
    table = spark.createDataFrame([(0.0, 0.1), (1.0, 0.9), row], "label double, score double")
    with pytest.raises(PySparkException, match="0 or 1"):
        auc_exact(table).collect()


def test_three_labels_count(spark):
    table = spark.range(900).select((F.col("id") % 3).cast("double").alias("label"), (F.col("id") % 7).cast("double").alias("x"))
    table = table.withColumn("x", F.when(F.col("label") == 2, 0.0).otherwise(F.col("x")))
    own = chi_square_table(table, ["x"]).first()
    vectors = VectorAssembler(inputCols=["x"], outputCol="v").transform(table)
    library = ChiSquareTest.test(vectors, "v", "label", flatten=True).first()
    assert own["dof"] == library["degreesOfFreedom"]
    assert math.isclose(own["statistic"], library["statistic"], rel_tol=1e-9)
