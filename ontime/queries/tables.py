"""Queries over tables: scans, cleaning, features, profiles, charts, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime import config
from ontime.functions import hour_from_hhmm, is_parquet, zone_path
from ontime.operators import (
    add_label,
    add_season,
    add_time_of_day,
    add_times_of_day,
    arg_best,
    assign_parts,
    auc_exact,
    bar_counts,
    bar_counts_many,
    bottom_k,
    cast_columns,
    cell_counts,
    cast_where,
    chi_square_onehot,
    chi_square_table,
    classification_metrics,
    columns_by_type,
    columns_with_nulls,
    confusion_matrix,
    corr_matrix,
    count_where,
    describe_numeric,
    distinct_count,
    drop_columns,
    drop_nulls,
    duplicate_count,
    fill_missing,
    heatmap_long,
    histogram_unit,
    is_object_type,
    keep_at_least,
    non_null_counts,
    null_counts,
    preview,
    profile,
    profile_categorical,
    profile_numeric,
    random_split,
    roc_chart,
    roc_points,
    row_count,
    row_count_audit,
    rows_with_nulls,
    sample_rows,
    scatter_grid,
    select_columns,
    shape_profile,
    sketched_profile,
    top_k,
    value_counts,
)
from ontime.operators.filters import at_least, has_values
from ontime.operators.profile import numeric_counts
from ontime.operators.projection import numeric_columns
from ontime.plans import cleaning_job, read_sketches, sketch_cleaned
from ontime.plans.cleaning import CLEANED, LANDING, clean_due_files
from ontime.plans.flights import ROW_KEY
from ontime.queries import stages
from ontime.session import new_folder
from ontime.sources import (
    landing_inventory,
    last_notes,
    read_chart,
    read_cleaned,
    read_landing,
    read_notes,
    write_chart,
    write_zone,
)
from ontime.sources.ledger import LEDGER

CATEGORIES = [*config.STRING_CATEGORIES, *config.INTEGER_CATEGORIES]
HISTOGRAM_COLUMNS = ["ActualElapsedTime", "ArrDelayMinutes", "DepDelay", "CRSDepTime"]
SCATTER_BINS = 50
SKETCH_ACCURACY = 10_000
TIMES = ("CRSArrTime", "CRSDepTime")
LAST_FILE = "lineitem.parquet"
# Flights of earlier years land first.
EARLY_YEARS = 1998
NULLABLE = ["DepTime", "DepDelay", "ArrTime", "ArrDelay", "AirTime"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that summation order does not show."""
    return df.select(
        *[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    )


def dates_as_text(df: DataFrame) -> DataFrame:
    return cast_where(df, lambda kind: kind in ("date", "timestamp_ntz"), "string")


# Scans and sinks


def scan_landing(spark: SparkSession, d: str) -> DataFrame:
    return dates_as_text(read_landing(spark, d, glob="orders.parquet").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date")
    ))


def scan_cleaned(spark: SparkSession, d: str) -> DataFrame:
    table = read_cleaned(spark, f"{d}/lineitem.parquet")
    return dates_as_text(table.withColumn("l_shipdate", F.col("l_shipdate").cast("date")))


def scan_until(spark: SparkSession, d: str) -> DataFrame:
    files = read_landing(spark, d, last_file=LAST_FILE, merge_schema=True)
    return files.groupBy("source_file").agg(F.count("*").alias("n_rows"))


def zone_rename(spark: SparkSession, d: str) -> DataFrame:
    files = read_landing(spark, d, merge_schema=True)
    path = F.concat(F.lit("landing/"), "source_file")
    return (
        files.groupBy("source_file")
        .agg(F.count("*").alias("n_rows"))
        .select("n_rows", zone_path(path).alias("target"), is_parquet(path).alias("is_parquet"))
    )


def file_inventory(spark: SparkSession, d: str) -> DataFrame:
    """The listing with each file's row count."""
    counted = read_landing(spark, d, merge_schema=True).groupBy("source_file").agg(F.count("*").alias("n_rows"))
    listed = landing_inventory(spark, d).select("file_name", (F.col("size_bytes") > 0).alias("has_bytes"))
    return listed.join(counted, listed.file_name == counted.source_file, "left").select("file_name", "has_bytes", "n_rows")


def summary_all(spark: SparkSession, d: str) -> DataFrame:
    """The approximate summary, each sketched mark as whether its rank is near enough."""
    table = stages.featured(spark, d)
    summary = describe_numeric(table, approx=True, accuracy=SKETCH_ACCURACY)
    marks = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    # One row per profiled column joins the value counts.
    counts = numeric_counts(table, numeric_columns(table)).join(F.broadcast(summary.select("column", *marks)), "column")
    n, value, slack = F.sum("n"), F.col("value"), 1 / SKETCH_ACCURACY
    near = counts.groupBy("column").agg(
        *[
            (
                (F.sum(F.when(value < F.col(m), F.col("n")).otherwise(0)) <= (p + slack) * n + 1)
                & (F.sum(F.when(value <= F.col(m), F.col("n")).otherwise(0)) >= (p - slack) * n - 1)
            ).alias(m)
            for m, p in marks.items()
        ]
    )
    return rounded(summary.drop(*marks)).join(near, "column")


def split_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Rows and keys over both parts of the random split, keys in both, and the share."""
    train, test = random_split(stages.featured(spark, d))
    both = train.select(ROW_KEY, F.lit(0).alias("part")).unionByName(test.select(ROW_KEY, F.lit(1).alias("part")))
    keys = both.groupBy(ROW_KEY).agg(F.count("*").alias("n"), F.sum("part").alias("in_test"))
    share = F.sum("in_test") / F.sum("n")
    return keys.agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.count_if((F.col("in_test") > 0) & (F.col("in_test") < F.col("n"))).alias("n_in_both"),
        (F.abs(share - config.SPLIT_WEIGHTS[1]) < 5 / F.sqrt(F.sum("n"))).alias("share_near"),
    )


def write_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """The cleaning job from landing to cleaned, read back."""
    schema = stages.raw(spark, d).schema
    result = cleaning_job(spark, stages.work_folder(spark, d), schema=schema, carry=[ROW_KEY])
    table = cast_columns(read_cleaned(spark, result.path), {"FlightDate": "string"})
    return select_columns(table, [*config.FLIGHT_COLUMNS, ROW_KEY])


def scan_landing_folder(spark: SparkSession, d: str) -> DataFrame:
    """Every file of a landing folder as one table."""
    schema = stages.raw(spark, d).schema
    files = read_landing(spark, f"{stages.work_folder(spark, d)}/{LANDING}", schema=schema, required=schema.names)
    return dates_as_text(files.drop("source_file"))


def incremental_cleaning(spark: SparkSession, d: str) -> DataFrame:
    """Two runs of the cleaning job over a landing folder that grows in between: what
    each has cleaned, and how many files of the first run the second one wrote anew."""
    root, rows = new_folder(spark, "incremental"), stages.raw(spark, d)
    early = F.coalesce(F.col("Year") < EARLY_YEARS, F.lit(False))
    written = []
    for arrived, mode in ((rows.filter(early), "overwrite"), (rows.filter(~early), "append")):
        write_zone(arrived, root, LANDING, mode=mode)
        written.append(set(cleaning_job(spark, root, schema=rows.schema, carry=[ROW_KEY]).files))
    runs = last_notes(read_notes(spark, f"{root}/{LEDGER}")).select(F.col("file_name").alias("source_file"), "run")
    return (
        read_cleaned(spark, f"{root}/{CLEANED}")
        .join(runs, "source_file")
        .groupBy("run")
        .agg(
            F.count("*").alias("n_rows"), F.min("Year").alias("first_year"), F.max("Year").alias("last_year"),
            F.count_distinct(ROW_KEY).alias("n_keys"), F.lit(len(written[0] & written[1])).cast("bigint").alias("n_rewritten"),
        )
    )


def sketched_columns(spark: SparkSession, d: str) -> DataFrame:
    """The profile of the cleaned zone from stored sketches, made in two steps as the
    landing folder grew: the second one read the files of the second run only."""
    return rounded(sketched_profile(read_sketches(spark, sketched_root(spark, d))))


def sketched_root(spark: SparkSession, d: str) -> str:
    def build() -> str:
        root, rows = new_folder(spark, "sketched"), stages.by_year(stages.raw(spark, d))
        early = F.coalesce(F.col("Year") < EARLY_YEARS, F.lit(False))
        for arrived, mode in ((rows.filter(early), "overwrite"), (rows.filter(~early), "append")):
            write_zone(arrived.drop("source_file"), root, LANDING, mode=mode)
            clean_due_files(spark, root, schema=rows.drop("source_file").schema, carry=[ROW_KEY])
            sketch_cleaned(spark, root)
        return root

    return stages._once(spark, d, "sketched", build)


def sketch_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """What stored sketches hold exactly, and whether their estimates are near: ranks
    within one percent of the rows, distinct counts within ten percent."""
    zone = read_cleaned(spark, f"{sketched_root(spark, d)}/{CLEANED}")
    made = sketched_columns(spark, d)
    marks = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    # One row per profiled column joins the value counts.
    counts = numeric_counts(zone, config.NUMERICAL_COLUMNS).join(F.broadcast(made.select("column", *marks)), "column")
    n, value = F.sum("n"), F.round("value", 6)
    below = {m: F.sum(F.when(value < F.col(m), F.col("n")).otherwise(0)) for m in marks}
    upto = {m: F.sum(F.when(value <= F.col(m), F.col("n")).otherwise(0)) for m in marks}
    ranks = counts.groupBy("column").agg(
        *[((below[m] <= (p + 0.01) * n + 1) & (upto[m] >= (p - 0.01) * n - 1)).alias(m) for m, p in marks.items()]
    )
    cells = cell_counts(zone, config.FLIGHT_COLUMNS).filter(F.col("value").isNotNull())
    distinct = cells.groupBy("column").agg(F.count("*").alias("n_exact"))
    near = F.abs(F.col("n_distinct") - F.col("n_exact")) <= 0.1 * F.col("n_exact") + 1
    return (
        made.drop(*marks).join(ranks, "column", "left").join(distinct, "column")
        .withColumn("distinct_near", near).drop("n_exact", "n_distinct")
    )


def chart_sink(spark: SparkSession, d: str) -> DataFrame:
    root = new_folder(spark, "charts")
    chart = bar_counts(stages.featured(spark, d), "ScheduledDepTimeOfDay")
    write_chart(chart, root, "departures_by_time_of_day")
    return read_chart(spark, root, "departures_by_time_of_day")


# Filters


def elapsed_audit(spark: SparkSession, d: str) -> DataFrame:
    table = drop_columns(stages.raw(spark, d), ["DivAirportLandings"])
    steps = {"no_nulls": has_values(table), "crs_elapsed": at_least(table, "CRSElapsedTime", 0)}
    return row_count_audit(table, steps)


# Evaluation of the fixed score


def with_score_name(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("probability", "score")


def cutoffs(spark: SparkSession, d: str) -> DataFrame:
    """(cutoff, accuracy) of the fixed score, all cutoffs in one pass."""
    table = stages.scored(spark, d)
    levels = [0.3, 0.4, 0.5, 0.6, 0.7]
    right = [
        F.avg(((F.col("probability") > c) == (F.col("label") == 1)).cast("double")).alias(f"a{i}")
        for i, c in enumerate(levels)
    ]
    rows = [
        F.struct(F.lit(c).alias("cutoff"), F.col(f"a{i}").alias("accuracy"))
        for i, c in enumerate(levels)
    ]
    return table.agg(*right).select(F.inline(F.array(*rows)))


def onehot_tests(spark: SparkSession, d: str) -> DataFrame:
    return rounded(chi_square_onehot(stages.featured(spark, d), CATEGORIES), 4)


def confusion_heatmap(spark: SparkSession, d: str) -> DataFrame:
    cells = heatmap_long(confusion_matrix(stages.scored(spark, d)), "label", ["pred_0", "pred_1"])
    matrix = corr_matrix(stages.model_input(spark, d), config.CORRELATION_COLUMNS)
    pairs = matrix.select(F.col("a").alias("row"), F.col("b").alias("column"), F.col("r").alias("value"))
    return rounded(cells.unionByName(pairs))


QUERIES = {
    # Scans, sources, sinks
    "landing_inventory": file_inventory,
    "scan_landing": scan_landing,
    "scan_cleaned": scan_cleaned,
    "scan_until": scan_until,
    "write_cleaned": write_cleaned,
    "scan_landing_folder": scan_landing_folder,
    "incremental_cleaning": incremental_cleaning,
    "sketched_columns": sketched_columns,
    "sketch_accuracy": sketch_accuracy,
    "chart_sink": chart_sink,
    "shape_profile": lambda s, d: shape_profile(stages.raw(s, d)),
    # Projections
    "select_relevant": lambda s, d: dates_as_text(select_columns(stages.raw(s, d), config.FLIGHT_COLUMNS)),
    "drop_columns": lambda s, d: dates_as_text(
        drop_columns(stages.raw(s, d), ["DivAirportLandings", "NotAColumn"])
    ),
    "to_bool": lambda s, d: cast_columns(
        drop_nulls(stages.raw(s, d).select(ROW_KEY, "DepDel15", "ArrDel15")),
        {"DepDel15": "boolean", "ArrDel15": "boolean"},
    ),
    "ids_to_string": lambda s, d: cast_columns(
        stages.raw(s, d).select(ROW_KEY, "OriginAirportID", "DestAirportID"),
        {"OriginAirportID": "string", "DestAirportID": "string"},
    ),
    "objects_to_string": lambda s, d: dates_as_text(cast_where(stages.raw(s, d), is_object_type, "string")),
    "flags_to_int": lambda s, d: cast_columns(
        stages.cleaned(s, d).select(ROW_KEY, "ArrDel15", "DepDel15"), config.MODEL_CASTS
    ),
    "delay_groups_to_int": lambda s, d: cast_columns(
        stages.cleaned(s, d).select(ROW_KEY, "DepartureDelayGroups", "ArrivalDelayGroups"),
        config.DELAY_GROUP_CASTS,
    ),
    "label_to_double": lambda s, d: cast_columns(
        stages.model_input(s, d).select(ROW_KEY, "label"), {"label": "double"}
    ),
    # One row per column on both sides of the join.
    "columns_by_type": lambda s, d: columns_by_type(stages.raw(s, d)).join(
        non_null_counts(stages.raw(s, d)), "column"
    ),
    "preview": lambda s, d: dates_as_text(preview(stages.cleaned(s, d), 30, ROW_KEY)),
    # Filters and predicates
    "drop_nulls": lambda s, d: dates_as_text(drop_nulls(stages.raw(s, d))),
    "filter_actual_elapsed": lambda s, d: keep_at_least(
        stages.raw(s, d).select(ROW_KEY, "ActualElapsedTime"), "ActualElapsedTime", 0
    ),
    "filter_crs_elapsed": lambda s, d: keep_at_least(
        stages.raw(s, d).select(ROW_KEY, "CRSElapsedTime"), "CRSElapsedTime", 0
    ),
    "count_zero_delay": lambda s, d: count_where(
        stages.model_input(s, d), F.col("ArrDelayMinutes") == 0, "n_zero_delay"
    ),
    "sample_rows": lambda s, d: sample_rows(
        stages.raw(s, d).select(ROW_KEY, "Airline", "Distance"), 0.10, key=[ROW_KEY]
    ),
    "clean_flights": lambda s, d: dates_as_text(stages.cleaned(s, d)),
    "clean_for_model": lambda s, d: dates_as_text(stages.model_input(s, d)),
    "row_count_audit": elapsed_audit,
    # Derived columns
    "label_late": lambda s, d: add_label(stages.raw(s, d).select(ROW_KEY, "ArrDelayMinutes")),
    "hour_from_hhmm": lambda s, d: stages.raw(s, d).select(
        ROW_KEY,
        hour_from_hhmm(F.col("CRSDepTime")).alias("dep_hour"),
        hour_from_hhmm(F.col("CRSArrTime")).alias("arr_hour"),
    ),
    "time_of_day": lambda s, d: add_time_of_day(
        stages.raw(s, d).select(ROW_KEY, "DepTime"), "DepTime", "DepTimeOfDay"
    ).select(ROW_KEY, "DepTimeOfDay"),
    "time_of_day_pair": lambda s, d: add_times_of_day(stages.raw(s, d).select(ROW_KEY, *TIMES)),
    "season": lambda s, d: add_season(stages.raw(s, d).select(ROW_KEY, "Month")),
    "features_table": lambda s, d: stages.featured(s, d),
    "zone_rename": zone_rename,
    # Aggregations and profiling
    "non_null_counts": lambda s, d: non_null_counts(stages.raw(s, d)),
    "null_counts": lambda s, d: null_counts(stages.raw(s, d)),
    "columns_with_nulls": lambda s, d: columns_with_nulls(stages.raw(s, d)),
    "rows_with_nulls": lambda s, d: rows_with_nulls(stages.raw(s, d)),
    "duplicate_count": lambda s, d: duplicate_count(stages.raw(s, d).drop(ROW_KEY), hashed=True),
    "duplicate_count_exact": lambda s, d: duplicate_count(stages.raw(s, d).drop(ROW_KEY)),
    "duplicate_count_subset": lambda s, d: duplicate_count(stages.raw(s, d), ["Origin", "Dest", "Month"]),
    "describe_all": lambda s, d: rounded(describe_numeric(stages.raw(s, d))),
    "describe_column": lambda s, d: rounded(
        describe_numeric(stages.raw(s, d), ["ArrDelayMinutes"], percentiles=False)
    ),
    "summary_all": summary_all,
    "profile_numeric": lambda s, d: rounded(
        profile_numeric(stages.by_year(stages.cleaned(s, d)), "source_file")
    ),
    "profile_categorical": lambda s, d: profile_categorical(
        stages.by_year(stages.cleaned(s, d)), "source_file", config.CATEGORICAL_COLUMNS
    ),
    "profile_all": lambda s, d: rounded(profile(stages.raw(s, d).drop(ROW_KEY))),
    "row_count": lambda s, d: row_count(stages.raw(s, d)),
    "value_counts": lambda s, d: value_counts(stages.model_input(s, d), "ArrDel15"),
    "label_distribution": lambda s, d: value_counts(stages.model_input(s, d), "label"),
    "distinct_values": lambda s, d: distinct_count(stages.model_input(s, d), "Operating_Airline"),
    "confusion_pivot": lambda s, d: confusion_matrix(stages.scored(s, d)),
    "fill_zero": lambda s, d: fill_missing(stages.raw(s, d).select(ROW_KEY, *NULLABLE)),
    # Chart tables
    "bar_counts": lambda s, d: bar_counts(stages.featured(s, d), "ScheduledArrTimeOfDay"),
    "bar_counts_many": lambda s, d: bar_counts_many(stages.cleaned(s, d), config.CHART_CATEGORIES),
    "histogram_unit": lambda s, d: histogram_unit(stages.raw(s, d), HISTOGRAM_COLUMNS),
    "scatter_grid": lambda s, d: scatter_grid(
        stages.raw(s, d), config.SCATTER_X, config.SCATTER_Y, SCATTER_BINS
    ),
    "heatmap_long": confusion_heatmap,
    "roc_chart": lambda s, d: rounded(roc_chart(roc_points(stages.scored(s, d), "probability", bins=100, span=(0, 1)))),
    "chi_square_top20": lambda s, d: top_k(onehot_tests(s, d), "statistic", 20, "feature"),
    # Sorts, limits, top-k
    "sort_by_value": lambda s, d: value_counts(stages.featured(s, d), "Season", sort=True),
    "sort_by_label": lambda s, d: confusion_matrix(stages.scored(s, d)).orderBy("label"),
    "top_k": lambda s, d: top_k(
        stages.raw(s, d).select(ROW_KEY, "Airline", "Distance"), "Distance", 20, ROW_KEY
    ),
    "bottom_k": lambda s, d: bottom_k(
        stages.raw(s, d).select(ROW_KEY, "Airline", "Distance"), "Distance", 10, ROW_KEY
    ),
    "arg_best": lambda s, d: rounded(arg_best(cutoffs(s, d), "accuracy", "cutoff")),
    # Split
    "split_train_test": lambda s, d: assign_parts(stages.featured(s, d), [ROW_KEY]).select(ROW_KEY, "label", "part"),
    "random_split": split_sizes,
    "score_fixed": lambda s, d: rounded(
        stages.scored(s, d).select(ROW_KEY, "label", "probability", "prediction")
    ),
    # Statistics
    "corr_matrix": lambda s, d: rounded(
        corr_matrix(stages.model_input(s, d), config.CORRELATION_COLUMNS)
    ),
    "chi_square_category": lambda s, d: rounded(
        chi_square_table(stages.featured(s, d), [*CATEGORIES, *config.CONTINUOUS_COLUMNS]), 4
    ),
    "chi_square_onehot_sql": onehot_tests,
    # Evaluation
    "classification_metrics": lambda s, d: rounded(classification_metrics(stages.scored(s, d))),
    "auc_exact": lambda s, d: rounded(auc_exact(stages.scored(s, d), "probability")),
    "roc_points": lambda s, d: rounded(roc_points(stages.scored(s, d), "probability", span=(0, 1))),
}
