"""Small hand-made tables for edges that the flight table does not reach."""

import math

import pytest
from pyspark.sql import functions as F

from ontime.functions import hour_from_hhmm, late_label, season, time_of_day, zone_path
from ontime.operators import (
    arg_best,
    auc_exact,
    cast_columns,
    cell_counts,
    classification_metrics,
    columns_by_type,
    confusion_matrix,
    corr_matrix,
    corr_matrix_wide,
    describe_numeric,
    distinct_count,
    drop_columns,
    drop_nulls,
    duplicate_count,
    feature_pipeline,
    fill_missing,
    histogram_unit,
    keep_at_least,
    min_max,
    non_null_counts,
    null_counts,
    one_hot,
    profile,
    profile_categorical,
    profile_numeric,
    roc_points,
    rows_with_nulls,
    sample_rows,
    scatter_grid,
    select_columns,
    string_indexer,
    top_bottom,
    value_counts,
)
from ontime.operators.running import exact_percentiles

NAN = float("nan")


def column(spark, values, kind, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def test_clock_buckets(spark):
    clocks = [0, 459, 500, 1159, 1200, 1659, 1700, 2059, 2100, 2359, 2400, None]
    expected = [4, 4, 1, 1, 2, 2, 3, 3, 4, 4, 4, 4]
    for kind in ("int", "double"):
        table = column(spark, [None if c is None else (float(c) if kind == "double" else c) for c in clocks], kind)
        rows = table.select(time_of_day(F.col("x")).alias("b"), hour_from_hhmm(F.col("x")).alias("h")).collect()
        assert [r.b for r in rows] == expected
        assert [r.h for r in rows] == [None if c is None else c // 100 for c in clocks]


def test_unknown_clock_is_night(spark):
    assert column(spark, [NAN], "double").select(time_of_day(F.col("x")).alias("b")).first().b == 4


def test_seasons(spark):
    rows = column(spark, [*range(1, 13), None], "int").select(season(F.col("x")).alias("s")).collect()
    assert [r.s for r in rows] == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 1, 4]


def test_label_is_strict(spark):
    rows = column(spark, [0.0, 5.0, 5.0001, 6.0, None], "double").select(late_label(F.col("x")).alias("y")).collect()
    assert [r.y for r in rows] == [0, 0, 1, 1, 0]


def test_zone_path(spark):
    table = column(spark, ["bucket/landing/a.parquet", "landing/b.parquet"], "string")
    rows = table.select(zone_path(F.col("x")).alias("p")).collect()
    assert [r.p for r in rows] == ["bucket/cleaned/a.parquet", "cleaned/b.parquet"]


def test_null_and_nan(spark):
    table = spark.createDataFrame([(1.0, None), (NAN, 1.0), (2.0, 2.0)], "a double, b double")
    assert [tuple(r) for r in drop_nulls(table).collect()] == [(2.0, 2.0)]
    assert sorted(r.b for r in drop_nulls(table, ["b"]).collect()) == [1.0, 2.0]
    assert keep_at_least(table, "a", 0).count() == 2
    assert {r["column"]: r.n_values for r in non_null_counts(table).collect()} == {"a": 2, "b": 2}
    assert {r["column"]: r.n_nulls for r in null_counts(table).collect()} == {"a": 0, "b": 1}
    assert rows_with_nulls(table).first().n_rows == 2
    row = describe_numeric(table, ["a"]).first()
    assert (row.n_values, row["mean"], row["min"], row["max"]) == (2, 1.5, 1.0, 2.0)


def test_selection_is_strict_and_drop_is_not(spark):
    table = spark.range(1)
    assert drop_columns(table, ["id", "other"]).columns == []
    with pytest.raises(Exception):
        select_columns(table, ["id", "other"]).collect()


def test_number_to_boolean(spark):
    rows = cast_columns(column(spark, [0.0, 1.0, 2.0, None], "double"), {"x": "boolean"}).collect()
    assert [r.x for r in rows] == [False, True, True, None]


def test_type_classes(spark):
    table = spark.createDataFrame(
        [], "a int, b bigint, c double, d string, e array<int>, f date, g boolean, h decimal(9,2)"
    )
    classes = {r["column"]: r.type_class for r in columns_by_type(table).collect()}
    assert classes == {
        "a": "integer", "b": "integer", "c": "float", "d": "object", "e": "object",
        "f": "other", "g": "other", "h": "object",
    }


def test_duplicates_count_nulls_as_equal(spark):
    table = spark.createDataFrame([(None, 1), (None, 1), (None, 1), (2, 1)], "a int, b int")
    assert duplicate_count(table).first().n_duplicates == 2
    assert duplicate_count(table, ["b"]).first().n_duplicates == 3
    assert duplicate_count(table.limit(0)).first().n_duplicates == 0


def test_hashed_duplicates_tell_shifted_nulls_and_nested_values_apart(spark):
    table = spark.createDataFrame(
        [(None, 1, [[1], [2]]), (1, None, [[1], [2]]), (1, None, [[1, 2]]), (1, None, [[1, 2]])],
        "a int, b int, c array<array<int>>",
    )
    assert duplicate_count(table, hashed=True).first().n_duplicates == 1
    assert duplicate_count(table, ["a", "b"], hashed=True).first().n_duplicates == 2
    signs = spark.createDataFrame([(0.0,), (-0.0,), (NAN,), (NAN,), (None,)], "x double")
    for hashed in (False, True):
        assert duplicate_count(signs, hashed=hashed).first().n_duplicates == 2


def test_empty_table_is_described_per_column(spark):
    row = describe_numeric(column(spark, [], "double")).first()
    assert (row["column"], row.n_values, row["mean"], row.p50) == ("x", 0, None, None)


def test_duplicates_and_distinct_rows_make_the_table(spark):
    table = spark.range(1000).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"))
    assert duplicate_count(table).first().n_duplicates + table.distinct().count() == 1000


def test_array_cells_count_by_content(spark):
    table = spark.createDataFrame([([1, 2], "f"), ([1, 2], "f"), ([3], "f"), (None, "f")], "x array<int>, file string")
    row = profile_categorical(table, "file", ["x"]).first()
    assert (row.n_distinct, row.n_missing, row["min"], row["max"]) == (2, 1, "[1,2]", "[3]")


def test_profile_orders_values_in_their_own_type(spark):
    table = spark.createDataFrame(
        [("f", 9, 9.5, True), ("f", 10, 10.5, False), ("f", 100, NAN, None), ("g", None, None, None)],
        "file string, i int, d double, b boolean",
    )
    rows = {(r.file, r["column"]): r for r in profile_categorical(table, "file", ["i", "d", "b"]).collect()}
    assert (rows["f", "i"]["min"], rows["f", "i"]["max"]) == ("9", "100")
    assert (rows["f", "d"]["min"], rows["f", "d"]["max"], rows["f", "d"].n_missing) == ("9.5", "10.5", 1)
    assert (rows["f", "b"]["min"], rows["f", "b"]["max"]) == ("false", "true")
    assert (rows["g", "i"].n_distinct, rows["g", "i"]["min"], rows["g", "i"].n_missing) == (0, None, 1)


def test_signed_zero_is_one_value(spark):
    assert cell_counts(column(spark, [0.0, -0.0], "double"), ["x"]).count() == 1


def test_profile_numeric_per_file(spark):
    table = spark.createDataFrame([("f", 1.0), ("f", 3.0), ("f", None), ("g", 5.0)], "file string, x double")
    rows = {r.file: r for r in profile_numeric(table, "file").collect()}
    assert (rows["f"]["min"], rows["f"]["max"], rows["f"]["mean"], rows["f"].n_missing) == (1.0, 3.0, 2.0, 1)
    assert rows["f"]["std"] == pytest.approx(math.sqrt(2)) and rows["g"]["std"] is None


def test_profile_of_a_table_without_numbers(spark):
    rows = {(r.metric, r["column"]): r.value for r in profile(column(spark, ["a", "a", None], "string")).collect()}
    assert rows == {
        ("rows_with_nulls", "*"): 1.0, ("values", "x"): 2.0, ("has_nulls", "x"): 1.0, ("duplicate_rows", "*"): 1.0,
    }


def test_distinct_counts_null(spark):
    assert distinct_count(column(spark, ["a", "a", None], "string"), "x").first().n_distinct == 2


def test_value_counts_in_order(spark):
    rows = value_counts(column(spark, [3, 1, 3, 2], "int"), "x", sort=True).collect()
    assert [(r.x, r.n) for r in rows] == [(1, 1), (2, 1), (3, 2)]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1001])
def test_percentiles_interpolate(spark, n):
    table = spark.range(n).select((F.col("id") * F.col("id") / 3.0).alias("x"))
    row = describe_numeric(table, ["x"], percentiles=[0.0, 0.1, 0.5, 0.99, 1.0]).first()
    built_in = table.agg(F.percentile("x", [0.0, 0.1, 0.5, 0.99, 1.0]).alias("p")).first().p
    assert [row.p0, row.p10, row.p50, row.p99, row.p100] == pytest.approx(built_in)


def test_percentiles_with_one_value_in_a_third_of_the_rows(spark):
    table = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 77.0).otherwise(F.col("id") * 1.0).alias("x"))
    counts = table.groupBy(F.lit("x").alias("column"), F.col("x").alias("value")).agg(F.count("*").alias("n"))
    row = exact_percentiles(counts, [0.25, 0.3, 0.5]).first()
    built_in = table.agg(F.percentile("x", [0.25, 0.3, 0.5]).alias("p")).first().p
    assert [row.p25, row.p30, row.p50] == pytest.approx(built_in)


def test_unit_bins_are_centred(spark):
    rows = histogram_unit(column(spark, [0.4, 0.5, 1.49, -0.5, -0.51, None], "double"), ["x"]).collect()
    assert {r.bin: r.n for r in rows} == {0: 2, 1: 2, -1: 1}


def test_scatter_grid_edges(spark):
    table = spark.createDataFrame([(0.0, 5.0, 1.0), (10.0, 5.0, None), (5.0, 5.0, 3.0)], "x double, c double, y double")
    rows = {(r.y, r.x_bin, r.y_bin): r.n for r in scatter_grid(table, "x", ["c", "y"], bins=10).collect()}
    assert rows == {("c", 0, 0): 1, ("c", 9, 0): 1, ("c", 5, 0): 1, ("y", 0, 0): 1, ("y", 5, 9): 1}


def test_correlation_of_a_line(spark):
    table = spark.range(50).select(F.col("id").alias("a"), (F.col("id") * -2.0).alias("b"))
    cells = {(r.a, r.b): r.r for r in corr_matrix(table, ["a", "b"]).collect()}
    assert len(cells) == 4 and cells["a", "a"] == 1.0
    assert cells["a", "b"] == cells["b", "a"] == pytest.approx(-1.0)


def test_wide_correlation_agrees_with_pairs(spark):
    table = spark.range(200).select(
        (F.col("id") % 7).alias("a"), (F.col("id") % 11 * 1.5).alias("b"), F.sqrt("id").alias("c")
    )
    pairs = {(r.a, r.b): r.r for r in corr_matrix(table, ["a", "b", "c"]).collect()}
    wide = {(r.a, r.b): r.r for r in corr_matrix_wide(table, ["a", "b", "c"]).collect()}
    assert wide == pytest.approx(pairs)


def predictions(spark, rows):
    return spark.createDataFrame(rows, "label double, prediction double, score double")


def test_one_predicted_class(spark):
    table = predictions(spark, [(0.0, 0.0, 0.1), (1.0, 0.0, 0.2), (1.0, 0.0, 0.3)])
    assert [tuple(r) for r in confusion_matrix(table).orderBy("label").collect()] == [(0.0, 1, 0), (1.0, 2, 0)]
    row = classification_metrics(table).first()
    assert row.accuracy == pytest.approx(1 / 3)
    assert row.precision is None and row.recall == 0.0 and row.f1 is None


def test_no_predictions(spark):
    table = predictions(spark, [(0.0, 0.0, 0.1)]).limit(0)
    assert classification_metrics(table).first().accuracy is None
    assert auc_exact(table).first().auc is None


def brute_auc(rows):
    pos = [s for y, _, s in rows if y == 1]
    neg = [s for y, _, s in rows if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_area_gives_half_credit_for_ties(spark):
    rows = [(float(i % 2), 0.0, (i * 7 % 13) / 13) for i in range(60)]
    table = predictions(spark, rows)
    assert auc_exact(table).first().auc == pytest.approx(brute_auc(rows))
    flipped = table.withColumn("score", -F.col("score"))
    assert auc_exact(flipped).first().auc == pytest.approx(1 - brute_auc(rows))


def test_area_of_a_constant_score_is_a_half(spark):
    assert auc_exact(predictions(spark, [(0.0, 0.0, 0.5), (1.0, 0.0, 0.5)])).first().auc == 0.5


def test_area_needs_both_classes(spark):
    assert auc_exact(predictions(spark, [(1.0, 0.0, 0.5)])).first().auc is None


@pytest.mark.parametrize("bins", [10, None])
def test_roc_runs_from_corner_to_corner(spark, bins):
    rows = [(float(i % 3 == 0), 0.0, (i * 7 % 13) / 13) for i in range(60)]
    points = [(r.fpr, r.tpr) for r in roc_points(predictions(spark, rows), bins=bins).orderBy(F.desc("threshold")).collect()]
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    assert points == sorted(points)


def test_exact_roc_encloses_the_exact_area(spark):
    rows = [(float(i % 2), 0.0, (i * 5 % 17) / 17) for i in range(70)]
    points = [(r.fpr, r.tpr) for r in roc_points(predictions(spark, rows), bins=None).orderBy(F.desc("threshold")).collect()]
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(brute_auc(rows))


def test_fill_missing(spark):
    assert [r.x for r in fill_missing(column(spark, [None, 2], "int")).collect()] == [0, 2]


def test_best_row_ignores_nan_and_takes_the_first_of_equals(spark):
    table = spark.createDataFrame([(0, NAN), (1, 0.7), (2, 0.7), (3, None)], "position int, metric double")
    assert arg_best(table, "metric", "position").first().position == 1


def test_top_and_bottom(spark):
    rows = top_bottom(spark.range(100).withColumn("v", F.col("id") % 50), "v", 3, "id").collect()
    assert [r.id for r in rows if r.side == "top"] == [49, 99, 48]
    assert [r.id for r in rows if r.side == "bottom"] == [0, 50, 1]


def test_sample_depends_on_the_key_only(spark):
    table = spark.range(20000)
    chosen = {r.id for r in sample_rows(table, 0.1, key=["id"]).collect()}
    assert chosen == {r.id for r in sample_rows(table.repartition(13), 0.1, key=["id"]).collect()}
    assert 0.09 < len(chosen) / 20000 < 0.11
    assert 0 < sample_rows(table, 0.1).count() < 20000


def test_unseen_categories(spark):
    train = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 5.0), ("b", 1, 10.0)], "s string, m int, x double")
    test = spark.createDataFrame([("z", 3, 20.0)], "s string, m int, x double")
    index = string_indexer(["s"]).fit(train)
    assert index.transform(test).first().sIndex == 2.0
    encoder = one_hot(["s"], ["m"]).fit(index.transform(train))
    row = encoder.transform(index.transform(test)).first()
    assert row.sVector.toArray().tolist() == [0.0, 0.0, 1.0]
    assert row.mVector.toArray().sum() == 0.0
    features = feature_pipeline(["s"], ["m"], ["x"]).fit(train).transform(test).first().features
    assert features.toArray().tolist()[-1] == 2.0


def test_index_ties_are_alphabetical(spark):
    table = column(spark, ["b", "a", "c", "c"], "string", "s")
    assert list(string_indexer(["s"]).fit(table).labelsArray[0]) == ["c", "a", "b"]


def test_constant_column_scales_to_a_half(spark):
    table = column(spark, [3.0, 3.0], "double")
    for stage in min_max(["x"]):
        table = stage.fit(table).transform(table) if hasattr(stage, "fit") else stage.transform(table)
    assert table.first().xScaled.toArray().tolist() == [0.5]
