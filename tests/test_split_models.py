"""Splits, folds, training and saving."""

import math
import random

import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ontime.operators import (
    assign_parts,
    best_params,
    coefficients,
    confusion_matrix,
    default_grid,
    feature_names,
    grid_estimator,
    grid_scores,
    grid_search,
    hash_split,
    model_params,
    named_importances,
    param_grid,
    param_table,
    predict,
    random_split,
    score_linear,
    train_forest,
    train_logistic,
)
from ontime.queries import stages
from ontime.sources import save_model


def ids(df):
    return {r.id for r in df.select("id").collect()}


def test_hash_split_is_disjoint_complete_and_stable(spark):
    table = spark.range(20000)
    train, test = hash_split(table, ["id"])
    assert ids(train) & ids(test) == set() and ids(train) | ids(test) == set(range(20000))
    assert 0.68 < len(ids(train)) / 20000 < 0.72
    assert ids(hash_split(table.repartition(11), ["id"])[0]) == ids(train)
    assert ids(hash_split(table, ["id"], seed=43)[0]) != ids(train)


def test_hash_split_weights_need_not_sum_to_one(spark):
    counts = {r.part: r["count"] for r in assign_parts(spark.range(10000), ["id"], [2, 1, 1]).groupBy("part").count().collect()}
    assert 0.47 < counts[0] / 10000 < 0.53 and 0.22 < counts[1] / 10000 < 0.28 and sum(counts.values()) == 10000


def test_random_split_keeps_every_row(spark):
    train, test = random_split(spark.range(1000))
    assert train.count() + test.count() == 1000


def test_fixed_score(spark):
    row = score_linear(spark.range(1).select(F.lit(2).alias("a")), {"a": 1.5}, -3.0).first()
    assert row.probability == 0.5 and row.prediction == 0.0


@pytest.fixture(scope="module")
def planted(spark):
    """Label follows the first feature up and ignores the second."""
    rows = spark.range(4000).select(
        "id", (F.rand(1) * 2 - 1).alias("a"), (F.rand(2) * 2 - 1).alias("b"), F.rand(3).alias("u")
    )
    rows = rows.withColumn("label", (F.col("u") < 1 / (1 + F.exp(-3 * F.col("a")))).cast("double"))
    local = [(r.id, Vectors.dense(r.a, r.b), r.label) for r in rows.collect()]
    return spark.createDataFrame(local, ["id", "features", "label"]).repartition(4).cache()


def test_training_recovers_a_planted_signal(spark, planted):
    model = train_logistic(planted)
    values = {r.idx: r.coefficient for r in coefficients(model).collect()}
    assert values[0] == pytest.approx(3.0, abs=0.3) and abs(values[1]) < 0.2 and abs(values[-1]) < 0.2


def test_forest_recovers_a_planted_signal(spark):
    """Two of four features decide together, neither of them alone: no line separates the labels."""
    rng = random.Random(5)
    points = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(3000)]
    rows = [(i, Vectors.dense(p), float((p[1] > 0.1) != (p[3] > -0.2))) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, ["id", "features", "label"]).repartition(4)
    attrs = {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": f"x{i}"} for i in range(4)]}, "num_attrs": 4}}
    df = df.withColumn("features", F.col("features").alias("features", metadata=attrs))
    train, test = df.filter("id % 3 > 0"), df.filter("id % 3 = 0")
    forest = train_forest(train, num_trees=30, maxDepth=8)
    right = predict(forest, test).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    line = predict(train_logistic(train), test).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert right > 0.93 and line < right - 0.2
    weight = {r.name: r.importance for r in named_importances(forest, df).collect()}
    assert min(weight["x1"], weight["x3"]) > 3 * max(weight["x0"], weight["x2"])


def test_saved_model_predicts_the_same(spark, planted, tmp_path):
    model = train_logistic(planted, maxIter=5)
    loaded = LogisticRegressionModel.load(save_model(model, str(tmp_path / "model")))
    save_model(model, str(tmp_path / "model"))
    before = {r.id: r.prediction for r in predict(model, planted).collect()}
    assert before == {r.id: r.prediction for r in predict(loaded, planted).collect()}


def test_confusion_cells_sum_to_the_rows(spark, planted):
    cells = confusion_matrix(predict(train_logistic(planted, maxIter=5), planted)).collect()
    assert sum(r.pred_0 + r.pred_1 for r in cells) == 4000


def test_default_grid(spark):
    lr = grid_estimator()
    table = param_table(spark, default_grid(lr)).collect()
    assert len({r.params for r in table}) == 12 and lr.getMaxIter() == 5


def test_grid_search_prefers_the_fitting_model(spark, planted):
    lr = grid_estimator()
    grid = param_grid(lr, {"regParam": [0.0, 100.0], "elasticNetParam": [1.0]})
    search = grid_search(planted, lr, grid, fold_key=["id"], parallelism=2)
    scores = {r.position: r.metric for r in grid_scores(search).collect()}
    assert scores[0] > 0.8 and scores[1] == 0.5
    assert best_params(search).first().position == 0
    assert {r.param: r.value for r in model_params(search.bestModel.stages[0]).collect()}["maxIter"] == "5"


def test_keyed_folds_survive_repartitioning(spark, planted):
    lr = grid_estimator()
    grid = param_grid(lr, {"regParam": [0.1]})
    first = grid_search(planted, lr, grid, fold_key=["id"]).avgMetrics
    again = grid_search(planted.repartition(7), lr, grid, fold_key=["id"]).avgMetrics
    assert first == pytest.approx(again, abs=1e-9)


def test_value_queries_agree_with_the_models(spark, sf_dir):
    """Probabilities from the returned coefficients, importances from the trees, scores from the folds."""
    from ontime.queries import QUERIES

    weights = {r.idx: r.coefficient for r in QUERIES["coefficient_values"](spark, sf_dir).collect()}
    test = {r.RowKey: r.features for r in stages.trusted(spark, sf_dir)[1].select("RowKey", "features").collect()}
    rows = QUERIES["prediction_values"](spark, sf_dir).collect()
    assert len(rows) == stages.trusted(spark, sf_dir)[1].count()
    assert all(r.logistic_prediction == (r.logistic_score > 0.5) and r.forest_prediction == (r.forest_score > 0.5) for r in rows)
    for r in rows[:200]:
        vector = test[r.RowKey]
        margin = weights[-1] + sum(weights[int(i)] * v for i, v in zip(vector.indices, vector.values, strict=True))
        assert r.logistic_score == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-6)
    trees = stages.forest(spark, sf_dir).trees
    shares = {r.idx: r.importance for r in QUERIES["importance_values"](spark, sf_dir).collect()}
    sums = sum(t.featureImportances.toArray() for t in trees)
    assert sum(shares.values()) == pytest.approx(1)
    assert all(shares[i] == pytest.approx(v / sums.sum(), abs=1e-4) for i, v in enumerate(sums))


def test_test_rows_are_encoded_by_the_training_fit(spark, sf_dir):
    train, test = stages.trusted(spark, sf_dir)
    assert feature_names(train).collect() == feature_names(test).collect()
    names = [r.name for r in feature_names(train).orderBy("idx").collect()]
    assert names[-2:] == ["CRSElapsedTimeScaled_0", "DistanceScaled_0"]
    row = train.select("features").first()
    assert row.features.size == len(names)


def test_trusted_columns(spark, sf_dir):
    train, _ = stages.trusted(spark, sf_dir)
    assert len([c for c in train.columns if c != "RowKey"]) == 14
