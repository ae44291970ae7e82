"""The exact count of duplicate rows: wide rows travel only where they may have an equal."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from ontime.operators import duplicate_count

WIDTH = 12


@pytest.fixture(scope="module")
def wide(spark):
    """500 rows, 80 of which come three times, and rows with nulls, NaN and signed zeros."""
    ids = spark.range(500).select(*[(F.col("id") * (i + 3) % 1009).cast("double").alias(f"c{i}") for i in range(WIDTH)])
    odd = spark.createDataFrame(
        [(None,) * WIDTH, (None,) * WIDTH, (0.0,) * WIDTH, (-0.0,) * WIDTH, (float("nan"),) * WIDTH, (float("nan"),) * WIDTH, (None, *[1.0] * (WIDTH - 1)), (1.0, None, *[1.0] * (WIDTH - 2))],
        ", ".join(f"c{i} double" for i in range(WIDTH)),
    )
    again = ids.filter("c0 < 120")
    return ids.union(again).union(again).union(odd)


def by_value(df):
    return df.groupBy(*df.columns).count().agg(F.sum(F.col("count") - 1)).first()[0]


def test_count_is_that_of_the_values(wide):
    # The first row, all zeros, equals the two signed zeros.
    assert duplicate_count(wide).first().n_duplicates == by_value(wide) == 160 + 4


def test_more_repeats_than_are_broadcast(wide):
    assert duplicate_count(wide, few=3).first().n_duplicates == by_value(wide)


def test_wide_rows_are_told_apart_before_they_travel(wide):
    def joins(*args, **options):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            duplicate_count(*args, **options).explain()
        return "LeftSemi" in text.getvalue()

    assert joins(wide)
    assert not joins(wide, ["c0", "c1"])
