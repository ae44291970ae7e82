"""Landing to cleaned."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ontime import config
from ontime.operators import (
    cast_columns,
    cast_where,
    drop_nulls,
    is_object_type,
    keep_at_least,
    profile_categorical,
    profile_numeric,
    select_columns,
)
from ontime.sources import (
    drop_partitions,
    due_files,
    footer_columns,
    lacking,
    landing_inventory,
    last_notes,
    next_run,
    note,
    read_files,
    read_notes,
    read_zone,
    refuse,
    write_zone,
)
from ontime.sources.ledger import DONE, LEDGER, TAKEN

LANDING, CLEANED = "landing", "cleaned"
# Landing files that are cleaned in one job.
BATCH_FILES = 10_000


def clean_flights(
    df: DataFrame, columns: Sequence[str] = config.FLIGHT_COLUMNS, carry: Sequence[str] = ()
) -> DataFrame:
    """Flight records with every value present, a possible elapsed time and
    settled types. One narrow stage; ``carry`` keeps extra columns (a row key,
    the source file) that the null test leaves alone.
    """
    kept = drop_nulls(select_columns(df, [*columns, *carry]), columns)
    kept = keep_at_least(kept, "ActualElapsedTime", 0)
    return cast_where(cast_columns(kept, config.CLEAN_CASTS), is_object_type, "string")


class CleaningResult(NamedTuple):
    path: str
    numeric: DataFrame
    categorical: DataFrame
    # Names of the files that this run has cleaned.
    files: list[str]


def clean_due_files(
    spark: SparkSession,
    root: str,
    schema: StructType | str | None = None,
    last_file: str | None = None,
    carry: Sequence[str] = (),
    batch_files: int = BATCH_FILES,
) -> list[str]:
    """Clean the landing files that are new, changed or left unfinished, each into a
    folder of its own in the cleaned zone, and return their names.

    What other files have left there stays as it is. The footers of the due files are
    read first, and nothing is written if one lacks a column. Files are taken in order
    of name, ``batch_files`` at a time, and noted in the ledger before and after, so
    a run that is killed goes on where it was. Of a changed file without any clean row
    the old folder goes.
    """
    root = root.rstrip("/")
    cleaned, ledger = f"{root}/{CLEANED}", f"{root}/{LEDGER}"
    listing = landing_inventory(spark, f"{root}/{LANDING}")
    if last_file is not None:
        listing = listing.filter(F.col("file_name") <= last_file)
    notes = read_notes(spark, ledger)
    run = next_run(notes)
    # The listing of the due files: the driver would hold it for their scan anyway.
    due = due_files(listing, notes).collect()
    if not due:
        return []
    listed = spark.createDataFrame(due, "path string, size_bytes bigint, modified_at timestamp, file_name string")
    footers = footer_columns(listed)
    missing = lacking(footers, [*config.FLIGHT_COLUMNS, *carry]).orderBy("path").collect()
    refuse({row["path"]: row["lacks"] for row in missing})
    seen = last_notes(notes).select("file_name").distinct()
    known = {row["file_name"] for row in listed.join(seen, "file_name", "left_semi").collect()}

    files = sorted(listed.join(footers, "path").collect(), key=lambda row: row["file_name"])
    for start in range(0, len(files), batch_files):
        batch = files[start : start + batch_files]
        table = spark.createDataFrame(batch, "path string, size_bytes bigint, modified_at timestamp, file_name string, columns array<string>")
        note(table, ledger, run, TAKEN)
        landed = read_files(spark, [row["path"] for row in batch], schema)
        rows = clean_flights(landed, carry=[*carry, "source_file"])
        write_zone(rows, root, CLEANED, partition_by=["source_file"], only_touched=True)
        again = sorted({row["file_name"] for row in batch} & known)
        if again:
            empty = spark.createDataFrame([(name,) for name in again], "source_file string").join(
                rows.select("source_file").distinct(), "source_file", "left_anti"
            )
            drop_partitions(spark, cleaned, "source_file", [row[0] for row in empty.collect()])
        note(table, ledger, run, DONE)
    return [row["file_name"] for row in files]


def cleaning_job(
    spark: SparkSession,
    root: str,
    schema: StructType | str | None = None,
    last_file: str | None = None,
    carry: Sequence[str] = (),
    batch_files: int = BATCH_FILES,
) -> CleaningResult:
    """Clean the landing files that are due (see ``clean_due_files``) and profile the
    whole cleaned zone. A file that lacks a column is an error."""
    files = clean_due_files(spark, root, schema, last_file, carry, batch_files)
    written = read_zone(spark, root, CLEANED)
    return CleaningResult(
        f"{root.rstrip('/')}/{CLEANED}",
        profile_numeric(written, "source_file"),
        profile_categorical(written, "source_file", config.CATEGORICAL_COLUMNS),
        files,
    )
