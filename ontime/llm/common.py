"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.session import new_folder

# Python tasks work on slices of at most this many bytes of text (one longer
# text makes a slice of its own), whatever the size of Spark's batches.
SLICE_BYTES = 4_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` below the shared folder and read it back: the lineage ends
    there, so a lost executor does not undo the work before it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor


def has_remainder(doc_id: str, divisor: int, remainder: int) -> Column:
    """True where the id falls in the held-out part; a null id does not."""
    return F.coalesce(id_remainder(doc_id, divisor) == remainder, F.lit(False))


def lacks_remainder(doc_id: str, divisor: int, remainder: int) -> Column:
    """True where the row may be learned from; a null id has no remainder, so no."""
    return F.coalesce(id_remainder(doc_id, divisor) != remainder, F.lit(False))


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``limit`` bytes of text each."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, text: str) -> list[str]:
    """The texts of a slice, null as empty."""
    return [t or "" for t in batch.column(text).to_pylist()]


def with_fields(schema: T.StructType, fields: list[tuple[str, T.DataType]]) -> T.StructType:
    """The schema with the fields added; the name must not be taken."""
    taken = {f.name.lower() for f in schema.fields}
    for name, _ in fields:
        if name.lower() in taken:
            raise ValueError(f"there is a column {name} already; give another name")
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in fields)])


def append_columns(batch: pa.RecordBatch, arrays: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *names])


# Fixed values of the rolling hash: an odd base, its inverse modulo 2^64, two odd multipliers.
HASH_BASE = 0x9E3779B97F4A7C15
HASH_INVERSE = pow(HASH_BASE, -1, 1 << 64)
MIX_A, MIX_B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

# Powers that are kept between calls.
KEPT_POWERS = 1 << 18

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, a bounded number of them kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, KEPT_POWERS), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= KEPT_POWERS:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for each run of bytes; equal bytes have
    equal hashes wherever they stand."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(HASH_BASE, len(data)), out=sums[1:])
    raw = (sums[ends] - sums[starts]) * powers(HASH_INVERSE, len(data) + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(HASH_BASE))


def segment_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows, ``counts`` rows each; empty runs give zeros."""
    out = np.zeros((len(counts), *values.shape[1:]), np.float64)
    full = np.flatnonzero(counts)
    if len(full):
        firsts = (np.cumsum(counts) - counts)[full]
        out[full] = np.add.reduceat(values, firsts, axis=0, dtype=np.float64)
    return out
