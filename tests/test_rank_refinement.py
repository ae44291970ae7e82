"""Percentiles by rank refinement, duplicates confirmed by value, folds as partitions."""

import math
from importlib import import_module

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from ontime.operators import (
    describe_numeric,
    duplicate_count,
    grid_estimator,
    grid_scores,
    grid_search,
    param_grid,
    write_folds,
)
from ontime.operators import quantiles

# The package exports a function of that name.
profiles = import_module("ontime.operators.profile")

MARKS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]

SHAPES = {
    "spread": "xxhash64(id) / 1e9D",
    "squares": "id * id / 3.0D",
    "third": "if(id % 3 = 0, 77D, double(id))",
    "two": "double(id % 2)",
    "ends": "if(id % 200 = 0, id / 20000D, double(id % 2))",
    "gaps": "if(id % 5 != 0, double(id), null)",
    "infinite": "CASE WHEN id < 9000 THEN -double('infinity') WHEN id > 15000 THEN double('infinity') ELSE double(id) END",
    "same": "4D",
    "none": "CAST(null AS double)",
}


def same(left, right):
    return left == right or left == pytest.approx(right, rel=1e-12)


# The smallest leaf takes several rounds of sketches, the largest none.
@pytest.mark.parametrize("leaf", [1, 40, 2000, quantiles.LEAF])
def test_percentiles_of_any_shape_at_any_leaf(spark, leaf):
    table = spark.range(0, 20000, 1, 7).select(*[F.expr(v).alias(c) for c, v in SHAPES.items()])
    rows = {r["column"]: r for r in describe_numeric(table, percentiles=MARKS, leaf=leaf).collect()}
    assert set(rows) == set(SHAPES)
    built_in = table.agg(*[F.percentile(c, MARKS).alias(c) for c in SHAPES]).first()
    for c in SHAPES:
        found = [rows[c][m] for m in ("p0", "p1", "p25", "p50", "p90", "p100")]
        if c == "infinite":
            # Between equal infinities the built-in interpolates to NaN.
            ordered = sorted(r[c] for r in table.select(c).collect())
            assert found == [ordered[0], ordered[199], *found[2:4], ordered[-1], ordered[-1]]
            assert found[3] == (ordered[9999] + ordered[10000]) / 2
        else:
            assert same(found, built_in[c] or [None] * len(MARKS)), (c, found)


def test_a_sketch_that_misses_costs_a_scan_not_the_result(spark, monkeypatch):
    table = spark.range(20000).select((F.col("id") * 1.0).alias("x"))
    scans = []
    count = quantiles._count
    monkeypatch.setattr(quantiles, "_count", lambda *args: scans.append(1) or count(*args))
    around, wrong = quantiles.around, [(3, 5)] * 4
    monkeypatch.setattr(
        quantiles, "around", lambda grid, share: tuple(grid[i] for i in wrong.pop()) if wrong else around(grid, share)
    )
    row = describe_numeric(table, percentiles=[0.25, 0.999], leaf=30000).first()
    assert (row.p25, len(scans)) == (4999.75, 1)
    row = describe_numeric(table, percentiles=[0.25, 0.999], leaf=19000).first()
    assert (row.p25, len(scans)) == (4999.75, 3) and row["p99.9"] == pytest.approx(19979.001)


def test_only_values_near_the_ranks_are_counted(spark):
    table = spark.range(200000).select(F.lit("x").alias("column"), (F.col("id") * 1.0).alias("value"))
    row = table.agg(F.count("value").alias("n"), quantiles.sketch_grid("value").alias("grid")).first()
    searches = {"x": quantiles._Search([100000], [(*quantiles.around(row.grid, 0.5), 0)])}
    placed, edges = quantiles._placed(table, searches)
    inside = placed.filter("segment = 1").count()
    assert len(edges["x"]) == 1 and 0 < inside < 200000 * 6 / quantiles.GRID


def test_hash_collisions_are_not_duplicates(spark, monkeypatch):
    table = spark.range(500).select((F.col("id") % 400).alias("a"), F.lit("t").alias("b"))
    exact = duplicate_count(table).first().n_duplicates
    monkeypatch.setattr(profiles, "_row_hash", lambda names: F.xxhash64(F.col("a") % 7))
    assert duplicate_count(table, hashed=True).first().n_duplicates == exact == 100
    # Too many repeated hashes to broadcast: all rows are compared.
    assert duplicate_count(table, hashed=True, few=3).first().n_duplicates == 100


def test_hashed_duplicates_shuffle_hashes_and_suspects_only(spark):
    table = spark.range(1000).select("id", F.repeat(F.col("id").cast("string"), 100).alias("wide"))
    plan = duplicate_count(table.union(table.limit(1)), hashed=True)
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().toString()
    assert plan.first().n_duplicates == 1


@pytest.fixture(scope="module")
def noisy(spark):
    rows = spark.range(3000).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("u")).collect()
    local = [(r.id, Vectors.dense(round(r.a, 2), r.b), float(r.u < r.a)) for r in rows]
    return spark.createDataFrame(local, ["id", "features", "label"]).repartition(3).cache()


def test_grid_search_averages_equal_a_cross_validator(spark, noisy):
    lr = grid_estimator()
    grid = param_grid(lr, {"regParam": [0.01, 0.2, 50.0], "elasticNetParam": [0.0, 1.0]})
    found = grid_search(noisy, lr, grid, fold_key=["id"], parallelism=3)
    evaluator = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC", numBins=0)
    plain = CrossValidator(estimator=Pipeline(stages=[lr]), estimatorParamMaps=grid, evaluator=evaluator, numFolds=3, foldCol="fold")
    expected = plain.fit(write_folds(noisy, 3, ["id"])).avgMetrics
    assert found.avgMetrics == pytest.approx(expected, abs=1e-9)
    assert [r.metric for r in grid_scores(found).orderBy("position").collect()] == found.avgMetrics
    assert found.bestModel.stages[0].getRegParam() == grid[found.avgMetrics.index(max(found.avgMetrics))][lr.regParam]


def test_folds_prune_files(spark, noisy):
    table = write_folds(noisy, 3, ["id"])
    assert table.count() == 3000 and table.select("fold").distinct().count() == 3
    inside = [set(table.filter(F.col("fold") == k).inputFiles()) for k in range(3)]
    plan = table.filter(F.col("fold") != 1)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(fold" in plan and len(set.union(*inside)) >= 3


def test_random_folds_and_folds_of_one_class(spark, noisy):
    lr = grid_estimator()
    grid = param_grid(lr, {"regParam": [0.01]})
    assert 0.7 < grid_search(noisy, lr, grid).avgMetrics[0] < 0.9
    with pytest.raises(ValueError, match="both classes"):
        grid_search(noisy.filter("label = 1"), lr, grid, folds=2)
