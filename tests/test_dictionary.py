"""Dictionaries of categories against the string indexer and plain counting."""

from collections import Counter

import pytest
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import functions as F

from ontime.operators import category_dictionary, dictionary_sizes, index_by_dictionary, string_indexer
from ontime.operators.encode import index_name


def plain(values):
    counts = Counter(v for v in values if v is not None)
    order = sorted(counts, key=lambda v: (-counts[v], v.encode()))
    return {v: (counts[v], i) for i, v in enumerate(order)}


VALUES = ["b", "a", "b", "c", None, "", "a", "ü", "z", "b", "\U0001f600", "￮"]


def test_most_frequent_first_ties_in_byte_order(spark):
    df = spark.createDataFrame([(v, "same") for v in VALUES], "x string, y string").repartition(5)
    rows = category_dictionary(df, ["x", "y"]).collect()
    assert {r.value: (r.n, r.idx) for r in rows if r["column"] == "x"} == plain(VALUES)
    assert [(r.value, r.n, r.idx) for r in rows if r["column"] == "y"] == [("same", len(VALUES), 0)]


@pytest.mark.parametrize("head", [1, 3, 10_000])
def test_index_equals_the_string_indexer(spark, head):
    """With few values broadcast, most rows go through the second join."""
    values = [v for v in VALUES if v != "\U0001f600"]
    rows = [(i, v, "hot" if i % 3 else f"k{i}") for i, v in enumerate(values * 40)]
    df = spark.createDataFrame(rows, "id int, x string, y string").repartition(7)
    got = index_by_dictionary(df, category_dictionary(df, ["x", "y"]), ["x", "y"], head=head)
    want = string_indexer(["x", "y"]).fit(df).transform(df)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
    assert got.columns == want.columns


def test_values_never_seen_get_the_last_index(spark):
    known = spark.createDataFrame([("a",), ("b",), ("a",)], "x string")
    new = spark.createDataFrame([("a",), ("q",), (None,), ("b",)], "x string")
    got = index_by_dictionary(new, category_dictionary(known, ["x"]), ["x"], head=1).collect()
    assert {(r.x, r.xIndex) for r in got} == {("a", 0.0), ("b", 1.0), ("q", 2.0), (None, 2.0)}
    assert len(got) == 4


def test_empty_table(spark):
    empty = spark.createDataFrame([], "x string")
    dictionary = category_dictionary(empty, ["x"])
    assert dictionary.count() == 0 and dictionary_sizes(dictionary) == {}
    rows = index_by_dictionary(spark.createDataFrame([("a",)], "x string"), dictionary, ["x"]).collect()
    assert [tuple(r) for r in rows] == [("a", 0.0)]


def test_one_hot_takes_the_width_from_the_index(spark):
    df = spark.createDataFrame([(v,) for v in "abcaab"], "x string")
    indexed = index_by_dictionary(df, category_dictionary(df, ["x"]), ["x"])
    encoder = OneHotEncoder(inputCols=[index_name("x")], outputCols=["v"], handleInvalid="keep")
    rows = encoder.fit(indexed.limit(0)).transform(indexed).collect()
    assert {(r.x, r.v.size, int(r.v.indices[0])) for r in rows} == {("a", 4, 0), ("b", 4, 1), ("c", 4, 2)}


def test_half_a_million_values(spark):
    """Every value its own rank; a third of the rows hold one value."""
    n = 600_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("v%07d", "id")).alias("x"))
    dictionary = category_dictionary(df, ["x"])
    marks = dictionary.agg(
        F.count("*").alias("n"), F.count_distinct("idx").alias("d"), F.max("idx").alias("top"),
        F.max_by("value", F.col("n")).alias("first"), F.max(F.when(F.col("value") == "v0000001", F.col("idx"))).alias("second"),
    ).first()
    assert tuple(marks) == (400_001, 400_001, 400_000, "hot", 1)
