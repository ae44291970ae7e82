"""Column names of many Parquet files, read from their footers by tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Files of one task: opening a file costs some ten milliseconds.
FILES_PER_TASK = 50
FOOTER = "path string, columns array<string>"


def footer_names(path: str) -> list[str] | None:
    """The column names of a file; None if this machine cannot open the path."""
    from pyarrow import fs, parquet

    try:
        system, inside = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    except (pa.ArrowInvalid, NotImplementedError, OSError, ImportError):
        return None
    with system.open_input_file(inside) as file:
        return parquet.read_schema(file).names


def footer_columns(files: DataFrame, path: str = "path") -> DataFrame:
    """(path, columns) per file of a listing.

    The listing is dealt out to tasks, which open the files and read no more than
    the footers: one job, however many files. Where a store's paths can only be
    opened by Spark, Spark reads those footers on the driver, one by one.
    """
    listed = files.select(F.col(path).alias("path")).distinct()
    tasks = max(1, -(-listed.count() // FILES_PER_TASK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [footer_names(p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.list_(pa.string()))], names=["path", "columns"])

    spark = files.sparkSession
    # One row of names per file: what the driver holds is a listing.
    table = listed.repartition(tasks, "path").mapInArrow(run, FOOTER).toArrow().to_pylist()
    rows = [(r["path"], r["columns"] if r["columns"] is not None else spark.read.parquet(r["path"]).columns) for r in table]
    return spark.createDataFrame(rows, FOOTER)


def lacking(footers: DataFrame, required: list[str]) -> DataFrame:
    """(path, lacks): the files without some of ``required``, with what they lack, in
    the order given; names are compared as Spark compares them."""
    have = F.transform("columns", F.lower)
    wanted = F.array(*map(F.lit, required)) if required else F.array().cast("array<string>")
    lacks = F.filter(wanted, lambda c: ~F.array_contains(have, F.lower(c)))
    return footers.select("path", lacks.alias("lacks")).filter(F.size("lacks") > 0)
