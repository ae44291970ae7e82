"""All models from one scan: the same numbers as one by one, curves, and errors."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ontime.operators import (
    auc_exact,
    classification_metrics,
    compare_fitted,
    compare_models,
    evaluate_models,
    model_params,
    predict,
    roc_curves,
    with_score,
)
from ontime.queries import QUERIES, stages


def plain_area(rows):
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("digits", [1, 3, 17])
def test_areas_against_all_pairs(spark, digits):
    """Ties within and across steps, scores a hair apart, the ends of the range."""
    rng = random.Random(digits)
    rows = []
    for model in ("a", "b"):
        for _ in range(150):
            s = rng.choice([0.0, 1.0, round(rng.random(), digits), 0.5 + rng.random() * 1e-9])
            rows.append((model, s, float(rng.random() < s), float(s > 0.5)))
    rows += [("one class", 0.25, 1.0, 0.0), ("one class", 0.75, 1.0, 1.0)]
    table = spark.createDataFrame(rows, "model string, score double, label double, prediction double").repartition(5)
    got = {r["model"]: r for r in evaluate_models(table).collect()}
    for model in got:
        own = [(s, y) for m, s, y, _ in rows if m == model]
        assert got[model]["auc"] == (None if plain_area(own) is None else pytest.approx(plain_area(own), abs=1e-12))
        cells = classification_metrics(table.filter(F.col("model") == model)).first()
        assert [got[model][c] for c in ("accuracy", "precision", "recall", "f1")] == [cells[c] for c in ("accuracy", "precision", "recall", "f1")]
    assert (got["one class"]["recall"], got["one class"]["precision"]) == (0.5, 1.0)
    for r in roc_curves(table, bins=10).filter("model = 'a'").collect():
        hit = [y for m, s, y, _ in rows if m == "a" and s >= r["threshold"]]
        own = [y for m, *_, y, _ in rows if m == "a"]
        assert r["tpr"] == pytest.approx(sum(hit) / sum(own)) and r["fpr"] == pytest.approx((len(hit) - sum(hit)) / (len(own) - sum(own)))


@pytest.mark.parametrize("row", [("a", 1.5, 1.0, 1.0), ("a", None, 1.0, 1.0), ("a", float("nan"), 0.0, 1.0), ("a", 0.5, 2.0, 1.0), ("a", 0.5, None, 0.0)])
def test_foreign_rows_are_errors(spark, row):
    table = spark.createDataFrame([row], "model string, score double, label double, prediction double")
    with pytest.raises(PySparkException):
        evaluate_models(table).collect()


def test_no_rows(spark):
    table = spark.createDataFrame([], "model string, score double, label double, prediction double")
    assert evaluate_models(table).count() == 0 and roc_curves(table).count() == 0


def test_fitted_models_in_one_scan(spark, sf_dir):
    test = stages.trusted(spark, sf_dir)[1]
    models = {"logistic": stages.logistic(spark, sf_dir), "forest": stages.forest(spark, sf_dir)}
    table = compare_fitted(models, test)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan") == 1
    together = {r["model"]: r for r in table.collect()}
    apart = {r["model"]: r for r in compare_models({n: predict(m, test) for n, m in models.items()}).collect()}
    for name, model in models.items():
        exact = auc_exact(with_score(predict(model, test))).first()["auc"]
        assert together[name]["auc"] == pytest.approx(exact, abs=1e-12)
        assert [together[name][c] for c in table.columns] == pytest.approx([apart[name][c] for c in table.columns])


def test_curve_and_parameters_of_the_tuned_model(spark, sf_dir):
    best = stages.search(spark, sf_dir).bestModel
    train = stages.trusted(spark, sf_dir)[0]
    points = sorted((r["fpr"], r["tpr"]) for r in QUERIES["roc_tuned"](spark, sf_dir).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:], strict=False))
    assert area == pytest.approx(auc_exact(with_score(predict(best, train))).first()["auc"], abs=2e-3)
    params = {r["param"]: r["value"] for r in QUERIES["tuned_params"](spark, sf_dir).collect()}
    assert params == {r["param"]: r["value"] for r in model_params(best.stages[0]).collect()}
    assert params["maxIter"] == "5" and float(params["regParam"]) in (0.0, 0.3, 0.6, 1.0)
    assert {r["model"] for r in QUERIES["model_metrics"](spark, sf_dir).collect()} == {"logistic", "tuned_logistic", "forest"}
