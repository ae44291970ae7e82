"""Confusion matrix, metrics and ROC of 0/1 predictions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.ml import Model
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.operators.models import with_score
from ontime.operators.running import running_totals


def _cell(label: int, prediction: int) -> Column:
    return F.count_if((F.col("label") == label) & (F.col("prediction") == prediction))


def _cells(predictions: DataFrame) -> DataFrame:
    """One row: tn, fp, fn, tp. Four counters per task, no shuffle of rows."""
    names = ["tn", "fp", "fn", "tp"]
    cells = predictions.agg(
        F.count("*").alias("n"),
        *[_cell(i // 2, i % 2).alias(name) for i, name in enumerate(names)],
    )
    # Every row has to be in a cell: another label or prediction, or a null, is an error.
    inside = reduce(add, [F.col(name) for name in names]) == F.col("n")
    message = F.lit("labels and predictions have to be 0 or 1")
    checked = [F.when(inside, F.col(name)).otherwise(F.raise_error(message).cast("bigint")).alias(name) for name in names]
    return cells.select(*checked)


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """(label, pred_0, pred_1), always both labels and both predictions, by label."""
    return _cells(predictions).selectExpr(
        "stack(2, 0.0D, tn, fp, 1.0D, fn, tp) AS (label, pred_0, pred_1)"
    )


def classification_metrics(predictions: DataFrame) -> DataFrame:
    """(accuracy, precision, recall, f1); null where a ratio has no denominator."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    ratios = _cells(predictions).select(
        F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return ratios.withColumn("f1", F.try_divide(2 * p * r, p + r))


def auc(predictions: DataFrame, raw: str = "rawPrediction", label: str = "label") -> float:
    """Area under ROC from at most 1000 threshold bins."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=raw, labelCol=label, metricName="areaUnderROC", numBins=1000
    )
    return evaluator.evaluate(predictions)


def _class_counts(predictions: DataFrame, score: str | Column, label: str) -> DataFrame:
    """(score, pos, neg); a label that is not 0 or 1, a null or a NaN score is an error."""
    value = F.col(score) if isinstance(score, str) else score
    wrong = F.raise_error(F.lit("labels have to be 0 or 1 and scores known"))
    known = value.isNotNull() & ~F.isnan(value.cast("double")) & F.col(label).isin(0, 1)
    known = F.when(known, F.col(label) == 1).otherwise(wrong.cast("boolean"))
    return predictions.select(value.alias("score"), known.alias("late")).select(
        "score", F.col("late").cast("bigint").alias("pos"), (~F.col("late")).cast("bigint").alias("neg")
    )


def auc_exact(predictions: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(auc): the share of positive/negative pairs in the right order, ties half.

    Null when a class is absent.
    """
    totals = running_totals(_class_counts(predictions, score, label), "score", ["pos", "neg"])
    # Pair counts pass the bigint range at cluster scale.
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    ordered = F.sum(pos * (F.col("neg_before") + neg / 2))
    pairs = F.max(F.col("pos_total").cast("double") * F.col("neg_total"))
    return totals.agg(F.try_divide(ordered, pairs).alias("auc"))


def roc_points(
    predictions: DataFrame,
    score: str = "score",
    label: str = "label",
    bins: int | None = 1000,
    span: tuple[float, float] | None = None,
) -> DataFrame:
    """(threshold, fpr, tpr) of the rule score >= threshold, from (0, 0) to (1, 1).

    ``bins`` rounds scores down to that many steps of ``span``; the window then
    sees at most ``bins + 2`` rows. Without a span the steps lie between the
    smallest and the largest finite score, infinite scores falling in the outer
    steps; a score outside a given span is an error. ``bins=None`` gives a point
    for every distinct score.
    """
    if bins is None:
        totals = running_totals(_class_counts(predictions, score, label), "score", ["pos", "neg"])
        points = totals.select(
            F.col("score").alias("threshold"),
            F.try_divide(F.col("neg_total") - F.col("neg_before"), "neg_total").alias("fpr"),
            F.try_divide(F.col("pos_total") - F.col("pos_before"), "pos_total").alias("tpr"),
        )
        start = predictions.sparkSession.range(1).select(
            F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
        )
        return points.unionByName(start)

    value = F.col(score).cast("double")
    if span is None:
        finite = F.when(F.abs(value) < float("inf"), value)
        bounds = predictions.agg(F.struct(F.min(finite).alias("low"), F.max(finite).alias("high"))).scalar()
        low, high = (F.coalesce(bounds.getField(name), F.lit(0.0)) for name in ("low", "high"))
        inside = F.least(F.greatest(value, low), high)
    else:
        low, high = (F.lit(float(bound)) for bound in span)
        outside = F.raise_error(F.lit(f"scores have to lie in {list(span)}")).cast("double")
        inside = F.when(value.between(low, high) | value.isNull() | F.isnan(value), value).otherwise(outside)
    width = high - low
    step = F.when(inside.isNotNull(), F.coalesce(F.floor(F.try_divide((inside - low) * bins, width)), F.lit(0)))
    counts = (
        _class_counts(predictions.withColumn("_step", F.when(~F.isnan(value), step)), "_step", label)
        .groupBy("score")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    start = predictions.sparkSession.range(1).select(
        F.lit(bins + 1).cast("bigint").alias("score"), F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("neg")
    )
    everything = Window.partitionBy()
    from_top = everything.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return counts.unionByName(start).select(
        (low + F.col("score") * width / bins).alias("threshold"),
        F.try_divide(F.sum("neg").over(from_top), F.sum("neg").over(everything)).alias("fpr"),
        F.try_divide(F.sum("pos").over(from_top), F.sum("pos").over(everything)).alias("tpr"),
    )


# Steps of a probability: within one, scores are told apart exactly.
STEPS = 1 << 20


def score_models(models: dict[str, Model], df: DataFrame, keep: Sequence[str] = ("label",)) -> DataFrame:
    """(model, *keep, score, prediction): every row under every model, from one scan.

    The models add their columns one after the other to the same row, which is
    then taken apart.
    """
    table, parts = df, []
    for i, name in enumerate(models):
        table = with_score(models[name].transform(table), f"_score{i}").withColumnRenamed("prediction", f"_prediction{i}")
        table = table.drop("rawPrediction", "probability")
        parts.append(F.struct(F.lit(name).alias("model"), F.col(f"_score{i}").alias("score"), F.col(f"_prediction{i}").alias("prediction")))
    return table.select(*keep, F.explode(F.array(*parts)).alias("_row")).select("_row.model", *keep, "_row.score", "_row.prediction")


def _probability(score: Column) -> Column:
    message = F.raise_error(F.lit("scores have to be probabilities")).cast("double")
    return F.when(score.between(0, 1), score).otherwise(message)


def _counters(scored: DataFrame, bins: int, by: Sequence[str] = ("model", "step", "score")) -> DataFrame:
    """(by, tn, fp, fn, tp): rows per model, step and distinct score, or fewer of these."""
    label, prediction = F.col("label"), F.col("prediction")
    known = label.isin(0, 1) & prediction.isin(0, 1)
    wrong = F.raise_error(F.lit("labels and predictions have to be 0 or 1")).cast("double")
    cells = scored.select("model", _probability(F.col("score")).alias("score"), F.when(F.coalesce(known, F.lit(False)), label * 2 + prediction).otherwise(wrong).alias("cell"))
    step = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1))
    counts = [F.count_if(F.col("cell") == i).alias(name) for i, name in enumerate(("tn", "fp", "fn", "tp"))]
    return cells.withColumn("step", step).groupBy(*by).agg(*counts)


def evaluate_models(scored: DataFrame) -> DataFrame:
    """(model, accuracy, precision, recall, f1, auc) from (model, label, score,
    prediction) rows whose scores are probabilities; one scan for all models.

    Each model's rows become counters per distinct score. The area is exact: pairs of
    scores in different steps are counted from the steps' totals, of which there are
    ``STEPS`` per model at most, pairs within a step by a window over its scores.
    Steps are a function of the score, so there are no boundaries to agree on and
    nothing is written. A ratio without a denominator is null, as is the area of one
    class. Labels or predictions other than 0 and 1 are an error.
    """
    pos, neg = (F.col("tp") + F.col("fn")).cast("double"), (F.col("tn") + F.col("fp")).cast("double")
    smaller = Window.partitionBy("model", "step").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    within = _counters(scored, STEPS).withColumn("pairs", pos * (F.coalesce(F.sum(neg).over(smaller), F.lit(0.0)) + neg / 2))
    cells = ("tn", "fp", "fn", "tp")
    steps = within.groupBy("model", "step").agg(F.sum("pairs").alias("pairs"), *[F.sum(c).alias(c) for c in cells])
    lower = Window.partitionBy("model").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    between = steps.withColumn("pairs", F.col("pairs") + pos * F.coalesce(F.sum(neg).over(lower), F.lit(0.0)))
    totals = between.groupBy("model").agg(F.sum("pairs").alias("pairs"), *[F.sum(c).alias(c) for c in cells])
    tn, fp, fn, tp = (F.col(c) for c in cells)
    ratios = totals.select(
        "model",
        F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide("pairs", pos * neg).alias("auc"),
    )
    p, r = F.col("precision"), F.col("recall")
    return ratios.withColumn("f1", F.try_divide(2 * p * r, p + r)).select("model", "accuracy", "precision", "recall", "f1", "auc")


def roc_curves(scored: DataFrame, bins: int = 1000) -> DataFrame:
    """(model, threshold, fpr, tpr) of the rule score >= threshold per model, from
    (0, 0) at a threshold above 1; ``bins + 1`` points a model at most, one scan."""
    pos, neg = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    steps = _counters(scored, bins, ("model", "step")).select("model", "step", pos.alias("pos"), neg.alias("neg"))
    whole = Window.partitionBy("model")
    higher = whole.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    points = steps.select(
        "model",
        (F.col("step") / bins).alias("threshold"),
        F.try_divide(F.sum("neg").over(higher), F.sum("neg").over(whole)).alias("fpr"),
        F.try_divide(F.sum("pos").over(higher), F.sum("pos").over(whole)).alias("tpr"),
    )
    start = steps.select("model").distinct().select("model", F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def compare_models(predictions: dict[str, DataFrame]) -> DataFrame:
    """(model, accuracy, precision, recall, f1, auc), one row per table of predictions."""
    tables = [
        with_score(table).select(F.lit(name).alias("model"), "label", "score", "prediction") for name, table in predictions.items()
    ]
    return evaluate_models(reduce(DataFrame.unionByName, tables))


def compare_fitted(models: dict[str, Model], df: DataFrame) -> DataFrame:
    """``compare_models`` of fitted models on one table, which is scanned once."""
    return evaluate_models(score_models(models, df))
