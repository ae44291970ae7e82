"""What the physical plans must and must not contain, and the jobs end to end."""

import io
import re
from contextlib import redirect_stdout
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ontime import config
from ontime.operators import feature_names, rows_with_nulls
from ontime.plans import cleaning_job, feature_job, flights, model_job
from ontime.plans.flights import ROW_KEY
from ontime.queries import QUERIES, stages
from ontime.session import shared_folder
from ontime.sources import landing_inventory, read_landing, write_zone


def plan(df) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_workers_and_no_cross_joins(spark, sf_dir, key):
    text = plan(QUERIES[key](spark, sf_dir))
    for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in text, node


def test_null_tests_and_range_reach_the_scan(spark, sf_dir):
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan(stages.cleaned(spark, sf_dir))).group(1)
    assert all(f"IsNotNull({c})" in pushed for c in config.FLIGHT_COLUMNS)
    assert "GreaterThanOrEqual(ActualElapsedTime,0.0)" in pushed


def test_later_files_are_not_opened(spark, sf_dir):
    def splits(last_file):
        table = read_landing(spark, sf_dir, glob="*o*.parquet", merge_schema=True, last_file=last_file)
        return table.rdd.getNumPartitions()

    assert splits("a") == 0 and splits("z") >= 2


def test_inventory_lists_files_without_reading_them(spark, sf_dir):
    table = landing_inventory(spark, sf_dir)
    files = {r.file_name: r.size_bytes for r in table.collect()}
    assert files == {p.name: p.stat().st_size for p in Path(sf_dir).glob("*.parquet")}
    assert "content" not in re.search(r"ReadSchema: (.*)", plan(table)).group(1)


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(stages.raw(spark, sf_dir).groupBy("Month").count())
    assert re.search(r"ReadSchema: struct<Month:int>", text)


def test_split_and_features_do_not_shuffle(spark, sf_dir):
    assert "Exchange" not in plan(QUERIES["split_train_test"](spark, sf_dir))
    assert "Exchange" not in plan(QUERIES["features_table"](spark, sf_dir))


def test_top_k_keeps_k_rows_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_k"](spark, sf_dir))


def test_parts_read_their_own_folder(spark, sf_dir):
    train, _ = stages.parts(spark, sf_dir)
    assert re.search(r"PartitionFilters: \[.*part.* = 0", plan(train))


def test_running_totals_window_has_a_partition(spark, sf_dir):
    text = plan(QUERIES["auc_exact"](spark, sf_dir))
    assert "Window" in text and "_range" in text


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_jobs_from_landing_to_models(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    write_zone(flights(spark, sf_dir).repartition(3), root, "landing")
    files = sorted(r.source_file for r in read_landing(spark, f"{root}/landing").select("source_file").distinct().collect())
    assert len(files) == 3

    result = cleaning_job(spark, root, carry=[ROW_KEY])
    table = spark.read.parquet(result.path)
    assert sorted(r.source_file for r in table.select("source_file").distinct().collect()) == files
    assert rows_with_nulls(table).first().n_rows == 0
    assert result.numeric.count() == 3 * 25  # 8 integer and 17 double columns
    assert result.categorical.count() == 3 * len(config.CATEGORICAL_COLUMNS)

    train, test, _ = feature_job(spark, root, [ROW_KEY])
    assert train.count() + test.count() == 5746
    assert feature_names(train).count() == feature_names(test).count()

    from ontime.operators import grid_estimator, param_grid

    lr = grid_estimator()
    grid = param_grid(lr, {"regParam": [0.0, 0.3]})
    table = model_job(spark, root, fold_key=[ROW_KEY], grid=grid)
    assert {r.model for r in table.collect()} == {
        "logistic_regression_model", "best_lr_model", "random_forest_model",
    }


def test_cleaning_stops_after_the_named_file(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    write_zone(flights(spark, sf_dir).repartition(3), root, "landing")
    landed = read_landing(spark, f"{root}/landing")
    files = sorted(r.source_file for r in landed.select("source_file").distinct().collect())
    result = cleaning_job(spark, root, last_file=files[1])
    kept = spark.read.parquet(result.path).select(F.col("source_file")).distinct()
    assert sorted(r.source_file for r in kept.collect()) == files[:2]
