"""Queries that encode, train, tune and evaluate."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ontime import config
from ontime.functions import hash_bucket
from ontime.operators import (
    auc,
    auc_exact,
    best_params,
    category_dictionary,
    chi_square,
    chi_square_named,
    coefficients,
    compare_fitted,
    feature_names,
    feature_pipeline,
    grid_scores,
    index_by_dictionary,
    min_max,
    model_params,
    named_coefficients,
    named_importances,
    one_hot,
    predict,
    roc_curves,
    score_models,
    slot_cells,
    string_indexer,
    top_bottom,
    with_score,
)
from ontime.operators.encode import FEATURES, index_name, scaled_name, vector_name, vector_width
from ontime.plans.flights import ROW_KEY
from ontime.queries import stages
from ontime.queries.tables import CATEGORIES, rounded
from ontime.session import new_folder
from ontime.sources import read_zone, save_model, write_zone

# The row key as a category: as many values as rows.
KEY_TEXT = "KeyText"


def fired_slot(values: Column) -> Column:
    """Position of the one in a 0/1 array; -1 if there is none."""
    return (F.array_position(values, F.lit(1.0)) - 1).cast("int")


def first_value(vector: str) -> Column:
    return vector_to_array(vector)[0]


def string_index(spark: SparkSession, d: str) -> DataFrame:
    table = stages.feature_table(spark, d).select(ROW_KEY, *config.STRING_CATEGORIES)
    indexed = string_indexer(config.STRING_CATEGORIES).fit(table).transform(table)
    return indexed.select(ROW_KEY, *map(index_name, config.STRING_CATEGORIES))


def keyed_categories(spark: SparkSession, d: str) -> DataFrame:
    table = stages.feature_table(spark, d)
    return table.select(ROW_KEY, *config.STRING_CATEGORIES, F.col(ROW_KEY).cast("string").alias(KEY_TEXT))


def dictionary_index(spark: SparkSession, d: str) -> DataFrame:
    """Indexes from a written dictionary, of few categories and of one per row."""
    table, cols = keyed_categories(spark, d), [*config.STRING_CATEGORIES, KEY_TEXT]
    root = new_folder(spark, "dictionary")
    write_zone(category_dictionary(table, cols), root, "values")
    indexed = index_by_dictionary(table, read_zone(spark, root, "values"), cols)
    return indexed.select(ROW_KEY, *map(index_name, cols))


def encode_onehot(spark: SparkSession, d: str) -> DataFrame:
    """The slot that fires per category column; -1 if none does."""
    table = stages.feature_table(spark, d).select(ROW_KEY, *CATEGORIES)
    stages_ = [
        string_indexer(config.STRING_CATEGORIES),
        one_hot(config.STRING_CATEGORIES, config.INTEGER_CATEGORIES),
    ]
    encoded = Pipeline(stages=stages_).fit(table).transform(table)
    slots = [fired_slot(vector_to_array(vector_name(c))).alias(c) for c in CATEGORIES]
    return encoded.select(ROW_KEY, *slots)


def minmax_scale(spark: SparkSession, d: str) -> DataFrame:
    """Test rows scaled by the bounds of the training rows."""
    train, test = stages.parts(spark, d)
    model = Pipeline(stages=min_max(config.CONTINUOUS_COLUMNS)).fit(train)
    scaled = [first_value(scaled_name(c)).alias(scaled_name(c)) for c in config.CONTINUOUS_COLUMNS]
    return rounded(model.transform(test).select(ROW_KEY, *scaled))


def vectorize_continuous(spark: SparkSession, d: str) -> DataFrame:
    table = stages.feature_table(spark, d).select(ROW_KEY, *config.CONTINUOUS_COLUMNS)
    for stage in min_max(config.CONTINUOUS_COLUMNS)[: len(config.CONTINUOUS_COLUMNS)]:
        table = stage.transform(table)
    return table.select(
        ROW_KEY, *[first_value(vector_name(c)).alias(vector_name(c)) for c in config.CONTINUOUS_COLUMNS]
    )


def feature_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vector width, positions of the ones and the scaled values, per row."""
    table = stages.feature_table(spark, d)
    result = feature_pipeline().fit(table).transform(table)
    return describe_vectors(result)


def describe_vectors(df: DataFrame) -> DataFrame:
    # Only the cells that are not zero: no slot of a vector is made for the others.
    plain = F.unwrap_udt(FEATURES)
    cells = df.select(
        ROW_KEY, F.coalesce(plain["size"], F.size(plain["values"])).alias("n_slots"), slot_cells(F.col(FEATURES)).alias("cells")
    )
    offset, fired = 0, []
    for c in CATEGORIES:
        slots = vector_width(df, vector_name(c))
        fired.append(fired_cell(offset, slots).cast("string"))
        offset += slots
    return cells.select(
        ROW_KEY,
        "n_slots",
        F.concat_ws("|", *fired).alias("active"),
        F.round(cell_value(offset), 6).alias("scaled_elapsed"),
        F.round(cell_value(offset + 1), 6).alias("scaled_distance"),
    )


def fired_cell(offset: int, slots: int) -> Column:
    """The first of ``slots`` slots from ``offset`` on that holds a one; else the slot before them."""
    ones = F.filter("cells", lambda cell: cell["idx"].between(offset, offset + slots - 1) & (cell["value"] == 1.0))
    return F.coalesce(F.get(ones, F.lit(0))["idx"], F.when(F.col("cells").isNotNull(), F.lit(offset - 1)))


def cell_value(idx: int) -> Column:
    """The value of a slot; zero if it has no cell."""
    own = F.filter("cells", lambda cell: cell["idx"] == idx)
    return F.coalesce(F.get(own, F.lit(0))["value"], F.when(F.col("cells").isNotNull(), F.lit(0.0)))


def part_sizes(train: DataFrame, test: DataFrame) -> DataFrame:
    tables = [t.withColumn("part", F.lit(name)) for name, t in (("train", train), ("test", test))]
    both = reduce(DataFrame.unionByName, tables)
    return both.groupBy("part").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col("label").cast("bigint")).alias("n_late"),
        F.max(F.size(vector_to_array(FEATURES))).alias("n_slots"),
    )


def model_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Save and load the baseline; rows on which both copies agree."""
    model, (_, test) = stages.logistic(spark, d), stages.trusted(spark, d)
    path = save_model(model, f"{new_folder(spark, 'models')}/logistic_regression_model")
    kept = predict(model, test).withColumnRenamed("prediction", "before")
    both = predict(
        LogisticRegressionModel.load(path), kept.drop("rawPrediction", "probability")
    )
    return both.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("before") == F.col("prediction")).alias("n_same")
    )


# Fitted numbers differ between engines, so these queries return what the fit has to satisfy.


def fold_sizes(train: DataFrame) -> Column:
    """Rows and late rows of each cross-validation fold, as one text."""
    fold = hash_bucket([ROW_KEY], f"fold {config.SEED}", config.FOLDS)
    sizes = train.groupBy(fold.alias("fold")).agg(F.count("*").alias("n"), F.sum(F.col("label").cast("bigint")).alias("late"))
    # One row per fold.
    return F.lit("|".join(f"{r.fold}:{r.n}:{r.late}" for r in sizes.orderBy("fold").collect()))


def linear_score(model: LogisticRegressionModel, features: Column) -> Column:
    """The dot product with the coefficients, plus the intercept."""
    weights = F.array(*[F.lit(float(w)) for w in model.coefficients.toArray()])
    terms = F.zip_with(features, weights, lambda x, w: x * w)
    return F.aggregate(terms, F.lit(float(model.intercept)), lambda total, term: total + term)


def balanced_slots(spark: SparkSession, d: str) -> DataFrame:
    """(idx, n_rows, n_late, balanced) per 0/1 slot that has training rows.

    At the unregularised optimum the mean probability of the rows of a slot is
    their share of late ones.
    """
    train = stages.trusted(spark, d)[0]
    scored = with_score(predict(stages.logistic(spark, d), train))
    # A row per slot that fires, not per slot of the vector.
    slots = scored.select("label", "score", F.inline(slot_cells(F.col(FEATURES))))
    binary = vector_width(train, FEATURES) - len(config.CONTINUOUS_COLUMNS)
    sums = slots.filter(F.col("idx") < binary).groupBy("idx").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col("label").cast("bigint")).alias("n_late"),
        F.avg("score").alias("mean_score"),
    )
    balanced = F.abs(F.col("mean_score") - F.col("n_late") / F.col("n_rows")) < 1e-4
    return sums.select("idx", "n_rows", "n_late", balanced.alias("balanced"))


def finite(column: str) -> Column:
    return (F.abs(column) < float("inf")).alias("finite")


def baseline_coefficients(spark: SparkSession, d: str) -> DataFrame:
    return coefficients(stages.logistic(spark, d)).select("idx", finite("coefficient"))


def baseline_named_coefficients(spark: SparkSession, d: str) -> DataFrame:
    named = named_coefficients(stages.logistic(spark, d), stages.trusted(spark, d)[0])
    return named.select("idx", "name", finite("coefficient"))


def tuned_top_bottom(spark: SparkSession, d: str) -> DataFrame:
    """The ten largest and smallest tuned coefficients: side, rank and whether the
    value is the one that rank has among all slots."""
    named = named_coefficients(stages.search(spark, d).bestModel.stages[0], stages.trusted(spark, d)[0])
    # At most one value per slot of the vector.
    values = sorted(r.coefficient for r in named.select("coefficient").collect())
    order = {"top": values[::-1], "bottom": values}
    picked = top_bottom(named, "coefficient", 10, "name").withColumn(
        "rank",
        F.row_number().over(
            Window.partitionBy("side").orderBy(F.when(F.col("side") == "top", -F.col("coefficient")).otherwise(F.col("coefficient")), "name")
        ),
    )
    expected = [F.when(F.col("side") == side, F.get(F.array(*map(F.lit, v[:10])), F.col("rank") - 1)) for side, v in order.items()]
    return picked.select(
        "side", "rank", (F.col("coefficient") == F.coalesce(*expected)).alias("in_order"), F.lit(len(values)).alias("n_slots")
    )


def baseline_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Per test row: the score agrees with the coefficients, the prediction with the score."""
    own = linear_score(stages.logistic(spark, d), vector_to_array(FEATURES))
    rows = with_score(stages.predicted(spark, d)).withColumn("raw", vector_to_array("rawPrediction")[1])
    return rows.select(
        ROW_KEY, "label",
        (F.abs(own - F.col("raw")) < 1e-6).alias("score_agrees"),
        (F.col("prediction") == (F.col("score") > 0.5).cast("double")).alias("prediction_agrees"),
    )


def forest_predictions(spark: SparkSession, d: str) -> DataFrame:
    rows = with_score(predict(stages.forest(spark, d), stages.trusted(spark, d)[1]))
    return rows.select(
        ROW_KEY, "label",
        F.col("score").between(0, 1).alias("in_range"),
        (F.col("prediction") == (F.col("score") > 0.5).cast("double")).alias("prediction_agrees"),
    )


def importances(spark: SparkSession, d: str) -> DataFrame:
    named = named_importances(stages.forest(spark, d), stages.trusted(spark, d)[0])
    total = named.agg(F.sum("importance")).first()[0]
    return named.select(
        "idx", "name", F.col("importance").between(0, 1).alias("in_range"), F.lit(abs(total - 1) < 1e-9).alias("sums_to_one")
    )


def prediction_values(spark: SparkSession, d: str) -> DataFrame:
    """Score and prediction of the baseline and the forest per test row, in one scan."""
    test = stages.trusted(spark, d)[1].select(ROW_KEY, "label", FEATURES)
    out = test
    for name, model in (("logistic", stages.logistic(spark, d)), ("forest", stages.forest(spark, d))):
        scored = with_score(predict(model, out), f"{name}_score")
        out = scored.withColumnRenamed("prediction", f"{name}_prediction").drop("rawPrediction", "probability")
    return out.drop(FEATURES)


def coefficient_values(spark: SparkSession, d: str) -> DataFrame:
    """(idx, name, coefficient) of the baseline, the intercept at -1 without a name."""
    model = stages.logistic(spark, d)
    names = feature_names(stages.trusted(spark, d)[0]).select("idx", "name")
    return coefficients(model).join(names, "idx", "left").select("idx", "name", "coefficient")


def grid_points(spark: SparkSession, d: str) -> DataFrame:
    scores = grid_scores(stages.search(spark, d))
    return scores.select(
        "position", "params", F.col("metric").between(0, 1).alias("in_range"), fold_sizes(stages.trusted(spark, d)[0]).alias("folds")
    )


def best_point(spark: SparkSession, d: str) -> DataFrame:
    """The best grid point: its metric is the maximum and the best model has its parameters."""
    search = stages.search(spark, d)
    model = {p.name: v for p, v in search.bestModel.stages[0].extractParamMap().items()}
    kept = F.from_json("params", "regParam double, elasticNetParam double")
    return best_params(search).select(
        (F.col("metric") == max(search.avgMetrics)).alias("is_best"),
        ((kept["regParam"] == model["regParam"]) & (kept["elasticNetParam"] == model["elasticNetParam"])).alias("model_has_params"),
        F.lit(len(search.avgMetrics)).alias("n_points"),
        fold_sizes(stages.trusted(spark, d)[0]).alias("folds"),
    )


def auc_model(spark: SparkSession, d: str) -> DataFrame:
    """Binned and exact area of the tuned model agree; rows per class."""
    test = stages.trusted(spark, d)[1]
    predictions = predict(stages.search(spark, d), test)
    exact, binned = auc_exact(with_score(predictions)).first().auc, auc(predictions)
    return test.agg(
        F.count_if(F.col("label") == 1).alias("n_late"),
        F.count_if(F.col("label") == 0).alias("n_on_time"),
        F.lit(abs(exact - binned) < 2e-3).alias("areas_agree"),
        F.lit(0.5 < exact <= 1).alias("beats_chance"),
    )


def fitted_models(spark: SparkSession, d: str) -> dict:
    return {
        "logistic": stages.logistic(spark, d),
        "tuned_logistic": stages.search(spark, d).bestModel,
        "forest": stages.forest(spark, d),
    }


def model_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The measures of the three models on the test rows."""
    return compare_fitted(fitted_models(spark, d), stages.trusted(spark, d)[1])


def tuned_curve(spark: SparkSession, d: str) -> DataFrame:
    """ROC of the tuned model on its training rows."""
    tuned = {"tuned_logistic": fitted_models(spark, d)["tuned_logistic"]}
    return roc_curves(score_models(tuned, stages.trusted(spark, d)[0]))


def tuned_curve_ends(spark: SparkSession, d: str) -> DataFrame:
    """Where the tuned model's curve begins and ends, that it never falls, and that a
    point's rates are those of whole numbers of the training rows."""
    points = tuned_curve(spark, d).drop("model")
    before = Window.orderBy(F.desc("threshold"))  # at most 1001 points
    steps = points.withColumns({"dx": F.col("fpr") - F.lag("fpr").over(before), "dy": F.col("tpr") - F.lag("tpr").over(before)})
    size = stages.trusted(spark, d)[0].agg(F.count("*").alias("n"), F.sum(F.col("label").cast("bigint")).alias("late")).first()
    late, on_time = F.col("tpr") * size.late, F.col("fpr") * (size.n - size.late)
    whole = (F.abs(late - F.round(late)) < 1e-6) & (F.abs(on_time - F.round(on_time)) < 1e-6)
    first = F.min_by(F.struct("fpr", "tpr"), -F.col("threshold"))
    last = F.min_by(F.struct("fpr", "tpr"), "threshold")
    return steps.agg(
        first["fpr"].alias("first_fpr"), first["tpr"].alias("first_tpr"), last["fpr"].alias("last_fpr"), last["tpr"].alias("last_tpr"),
        (F.min("dx") >= 0).alias("fpr_rises"), (F.min("dy") >= 0).alias("tpr_rises"), F.bool_and(whole).alias("whole_rows"),
        F.lit(size.late).cast("bigint").alias("n_late"), F.lit(size.n - size.late).cast("bigint").alias("n_on_time"),
    )


def tuned_params(spark: SparkSession, d: str) -> DataFrame:
    """All parameters of the best model of the search, defaults included."""
    return model_params(stages.search(spark, d).bestModel.stages[0])


def model_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Per model: rows, late rows, and whether the ratios are those of whole cell counts."""
    test = stages.trusted(spark, d)[1]
    compared = model_metrics(spark, d)
    size = test.agg(F.count("*").alias("n"), F.sum(F.col("label").cast("bigint")).alias("late")).first()
    right, hits = F.col("accuracy") * size.n, F.col("recall") * size.late
    return compared.select(
        "model",
        F.lit(size.n).cast("bigint").alias("n_rows"),
        F.lit(size.late).cast("bigint").alias("n_late"),
        ((F.abs(right - F.round(right)) < 1e-6) & (F.abs(hits - F.round(hits)) < 1e-6)).alias("whole_cells"),
        F.col("auc").between(0.5, 1).alias("auc_in_range"),
    )


QUERIES = {
    "write_trusted": lambda s, d: part_sizes(*stages.trusted(s, d)),
    "read_trusted": lambda s, d: stages.trusted(s, d)[0].select(ROW_KEY, "label"),
    "save_model": model_round_trip,
    # Encoding and scaling
    "string_index": string_index,
    "category_dictionary": lambda s, d: category_dictionary(
        keyed_categories(s, d), [*config.STRING_CATEGORIES, KEY_TEXT]
    ),
    "dictionary_index": dictionary_index,
    "encode_onehot": encode_onehot,
    "vectorize_continuous": vectorize_continuous,
    "minmax_scale": minmax_scale,
    "assemble_features": lambda s, d: describe_vectors(stages.encoded(s, d).train),
    "feature_pipeline": feature_vectors,
    "fit_transform_split": lambda s, d: part_sizes(stages.encoded(s, d).train, stages.encoded(s, d).test),
    "feature_names": lambda s, d: feature_names(stages.encoded(s, d).train),
    # Statistics over the vector
    "chi_square_slots": lambda s, d: rounded(chi_square(stages.trusted(s, d)[0]).drop("p_value"), 4),
    "chi_square_named": lambda s, d: rounded(chi_square_named(stages.trusted(s, d)[0]).drop("idx", "p_value"), 4),
    # Models and tuning
    "train_logistic": balanced_slots,
    "logistic_coefficients": baseline_coefficients,
    "named_coefficients": baseline_named_coefficients,
    "coef_top_bottom": tuned_top_bottom,
    "predict": baseline_predictions,
    "train_forest": forest_predictions,
    "forest_importances": importances,
    "grid_search": grid_points,
    "best_params": best_point,
    # The values behind the checked properties
    "coefficient_values": coefficient_values,
    "importance_values": lambda s, d: named_importances(stages.forest(s, d), stages.trusted(s, d)[0]),
    "prediction_values": prediction_values,
    "grid_values": lambda s, d: grid_scores(stages.search(s, d)),
    # Evaluation
    "auc_model": auc_model,
    "model_comparison": model_comparison,
    "model_metrics": model_metrics,
    "roc_tuned": tuned_curve,
    "roc_tuned_ends": tuned_curve_ends,
    "tuned_params": tuned_params,
}
