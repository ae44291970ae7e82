"""Writers and readers of the zone folders (cleaned, trusted, figures, models)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession

FIGURES = "figures"


def _join(root: str, zone: str) -> str:
    return f"{root.rstrip('/')}/{zone.strip('/')}"


def write_zone(
    df: DataFrame,
    root: str,
    zone: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    only_touched: bool = False,
) -> str:
    """Write ``df`` as Parquet below ``root/zone`` and return that path.

    ``only_touched`` overwrites the partitions that ``df`` has rows of and leaves
    the others as they are.

    No shuffle precedes the write. A task that reads a slice of one landing file
    writes into that file's folder only, so ``partition_by=["source_file"]``
    keeps one output folder per input at no extra cost.
    """
    path = _join(root, zone)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str]) -> None:
    """Delete the folders of the given values of a partition column."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    catalog = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for value in values:
        folder = hadoop.Path(path, f"{column}={catalog.escapePathName(value)}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_zone(spark: SparkSession, root: str, zone: str) -> DataFrame:
    return spark.read.parquet(_join(root, zone))


def write_chart(chart: DataFrame, root: str, name: str) -> str:
    """Store the table behind a figure under ``figures/<name>``."""
    return write_zone(chart, root, f"{FIGURES}/{name}")


def read_chart(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_zone(spark, root, f"{FIGURES}/{name}")


def save_model(model: MLWritable, path: str) -> str:
    """Save a fitted model, replacing an older one."""
    model.write().overwrite().save(path)
    return path
