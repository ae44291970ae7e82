"""Sketches of the cleaned zone, one set per source file, kept up to date by the ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime import config
from ontime.operators.projection import numeric_columns
from ontime.operators.sketches import SKETCHES, column_sketches
from ontime.plans.cleaning import BATCH_FILES, CLEANED
from ontime.sources import last_notes, read_notes, read_zone, write_zone
from ontime.sources.ledger import DONE, LEDGER

ZONE = "sketches"
STATE = "size_bytes bigint, modified_at timestamp"


def read_sketches(spark: SparkSession, root: str) -> DataFrame:
    """(source_file, size_bytes, modified_at, sketch columns); none if there are none yet."""
    schema = f"{STATE}, {SKETCHES}, source_file string"
    try:
        return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{ZONE}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def due_sketches(spark: SparkSession, root: str) -> DataFrame:
    """(source_file, size_bytes, modified_at) of the cleaned files whose sketches are
    missing or were made of another state of the landing file."""
    notes = last_notes(read_notes(spark, f"{root.rstrip('/')}/{LEDGER}")).filter(F.col("state") == DONE)
    cleaned = notes.select(F.col("file_name").alias("source_file"), "size_bytes", "modified_at")
    # One key per file, whatever its number of columns.
    made = read_sketches(spark, root).select("source_file", "size_bytes", "modified_at").distinct()
    return cleaned.join(made, ["source_file", "size_bytes", "modified_at"], "left_anti")


def sketch_cleaned(
    spark: SparkSession,
    root: str,
    categorical: Sequence[str] = config.CATEGORICAL_COLUMNS,
    batch_files: int = BATCH_FILES,
) -> list[str]:
    """Sketch the cleaned files that are due, and only those; return their names.

    The names select folders of the cleaned zone, so no other file is opened. Each
    file's sketches go to a folder of their own, and a run that is killed goes on with
    those it has not written. A file without clean rows gets rows with counts of zero.
    """
    due = sorted(due_sketches(spark, root).collect(), key=lambda row: row["source_file"])
    if not due:
        return []
    zone = read_zone(spark, root, CLEANED)
    texts = [c for c in categorical if c in zone.columns]
    numbers = [c for c in numeric_columns(zone) if c not in texts]
    columns = spark.createDataFrame(
        [*[(c, "number") for c in numbers], *[(c, "text") for c in texts]], "column string, kind string"
    )
    for start in range(0, len(due), batch_files):
        batch = due[start : start + batch_files]
        names = [row["source_file"] for row in batch]
        files = spark.createDataFrame(batch, f"source_file string, {STATE}")
        made = column_sketches(zone.filter(F.col("source_file").isin(names)), "source_file", numbers, texts)
        # A row per file of the batch and column of the table.
        wanted = files.withColumn("of", F.explode(F.array(*[F.struct(*map(F.lit, c)) for c in columns.collect()])))
        wanted = wanted.select("source_file", "size_bytes", "modified_at", "of.*").toDF(
            "source_file", "size_bytes", "modified_at", "column", "kind"
        )
        rows = wanted.join(made, ["source_file", "column", "kind"], "left").fillna(0, ["n_rows", "n_values"])
        names_in_order = [field.split()[0] for field in f"{STATE}, {SKETCHES}, source_file string".split(", ")]
        write_zone(rows.select(*names_in_order), root, ZONE, partition_by=["source_file"], only_touched=True)
    return [row["source_file"] for row in due]
