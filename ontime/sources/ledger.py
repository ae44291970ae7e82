"""Which landing files have been worked off: a table of notes that only grows.

Each run notes the files it takes, with size, time and columns, before it works on
them and again when their output is in place. A file is due if its last note is not
a finished one of the same size and time: new files, changed files, and those of a
run that was killed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "ledger"
TAKEN, DONE = "taken", "done"
NOTES = (
    "run int, noted_at timestamp, state string, file_name string, path string, "
    "size_bytes bigint, modified_at timestamp, columns array<string>"
)


def read_notes(spark: SparkSession, path: str) -> DataFrame:
    """All notes; none if there is no ledger yet."""
    try:
        return spark.read.schema(NOTES).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], NOTES)


def last_notes(notes: DataFrame) -> DataFrame:
    """The latest note of each file."""
    order = F.struct("run", F.col("state") == DONE)
    latest = notes.groupBy("path").agg(F.max_by(F.struct("run", "state", "file_name", "size_bytes", "modified_at", "columns"), order).alias("note"))
    return latest.select("path", "note.*")


def due_files(listing: DataFrame, notes: DataFrame) -> DataFrame:
    """The listed files that are new, changed or left unfinished."""
    done = last_notes(notes).filter(F.col("state") == DONE).select("path", "size_bytes", "modified_at")
    return listing.join(done, ["path", "size_bytes", "modified_at"], "left_anti")


def next_run(notes: DataFrame) -> int:
    return (notes.agg(F.max("run")).first()[0] or 0) + 1


def note(files: DataFrame, path: str, run: int, state: str) -> None:
    """Append a note per file of (file_name, path, size_bytes, modified_at, columns)."""
    rows = files.select(
        F.lit(run).alias("run"), F.current_timestamp().alias("noted_at"), F.lit(state).alias("state"),
        "file_name", "path", "size_bytes", "modified_at", "columns",
    )
    rows.coalesce(1).write.mode("append").parquet(path)
