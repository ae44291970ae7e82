"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

A fingerprint of 64 bits is cut into six blocks. Two fingerprints that differ in
at most three bits agree on at least three blocks, so they share the key made of
some three of the six: twenty keys of about 32 bits, which few unrelated
fingerprints share however many there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.llm.common import append_columns, free_name, materialise, slices, texts_of, with_fields

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BITS = 64
# Fingerprints that one task compares at a time; larger blocks are compared slice by slice.
SLICE = 2000
# Fingerprints in a block up to which all its pairs are compared by a join.
FEW = 16

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The bit majority over the XXH64 of all word shingles; zero without words."""
    words = WORD.findall(text.translate(LOWER) if not text.islower() else text)
    if not words:
        return 0
    joined = " ".join(words).encode()
    ends = np.cumsum([len(w.encode()) + 1 for w in words]) - 1
    first = max(min(shingle, len(words)) - 1, 0)
    stops = ends[first:].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], ">u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        counts += np.unpackbits(hashes[at : at + 65_536].view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def with_fingerprints(df: DataFrame, text: str = "text", shingle: int = SHINGLE, out: str = "fp") -> DataFrame:
    """The rows with their fingerprint as a signed 64-bit number. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                marks = np.array([fingerprint(t, shingle) for t in texts_of(part, text)], np.uint64).view(np.int64)
                yield append_columns(part, [pa.array(marks)], [out])

    return df.mapInArrow(run, with_fields(df.schema, [(out, T.LongType())]))


def block_keys(fp: Column, max_bits: int) -> list[Column]:
    """Keys of which two fingerprints share one if they differ in at most ``max_bits``."""
    blocks = 2 * max_bits
    bounds = [BITS * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - max_bits)):
        mask = sum((1 << bounds[b + 1]) - (1 << bounds[b]) for b in chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(number).alias("which"), fp.bitwiseAND(F.lit(signed)).alias("block")))
    return keys


def differing(a: np.ndarray, b: np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def spanning_links(left: np.ndarray, right: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect all that links between ``left`` and ``right`` (or within
    ``left``, if right is empty) connect: each fingerprint is reached once, from
    one that is near, so a dense block yields as many links as fingerprints."""
    sides = [left, right] if len(right) else [left]
    waiting = [s.copy() for s in sides]
    links: list[tuple[int, int]] = []
    for start_side in range(len(sides)):
        while len(waiting[start_side]):
            open_ = [(waiting[start_side][0], start_side)]
            waiting[start_side] = waiting[start_side][1:]
            while open_:
                mark, side = open_.pop()
                other = side if len(sides) == 1 else 1 - side
                near = differing(waiting[other], mark) <= max_bits
                if near.any():
                    found = waiting[other][near]
                    waiting[other] = waiting[other][~near]
                    links += [(int(mark), int(x)) for x in found]
                    open_ += [(x, other) for x in found]
    return links


def near_links(marks: DataFrame, max_bits: int = MAX_BITS, slice_size: int = SLICE) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that connect exactly what
    all pairs within ``max_bits`` connect.

    Blocks of a few fingerprints are compared by a join. In larger ones each
    fingerprint is linked once, to one that is near, instead of to all. Very
    large ones are cut into slices by a hash, and each pair of slices is a group
    of its own, so that no task sees more than two.
    """
    keyed = marks.select("fp", F.inline(F.array(*block_keys(F.col("fp"), max_bits)))) if max_bits else marks.select(
        "fp", F.lit(0).alias("which"), F.col("fp").alias("block")
    )
    shared = materialise(keyed.groupBy("which", "block").agg(F.count("*").alias("n")).filter("n > 1"), "shared")
    rows = materialise(keyed.join(shared, ["which", "block"]), "blocks")

    few = rows.filter(F.col("n") <= FEW)
    pairs = few.withColumnRenamed("fp", "a").join(few.select("which", "block", F.col("fp").alias("b")), ["which", "block"])
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    linked = pairs.filter((F.col("a") < F.col("b")) & near).select("a", "b")

    parts = F.ceil(F.col("n") / slice_size).cast("int")
    many = rows.filter(F.col("n") > FEW).withColumn("parts", parts)
    many = many.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    many = many.select(
        "fp", "which", "block", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        values, own = pdf["fp"].to_numpy().view(np.uint64), pdf["own"].to_numpy()
        low, high = pdf["low"].iloc[0], pdf["high"].iloc[0]
        right = values[own == high] if low < high else values[:0]
        found = np.array(spanning_links(values[own == low], right, max_bits), np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    spanned = many.groupBy("which", "block", "low", "high").applyInPandas(compare, "a long, b long")
    return linked.unionByName(spanned)


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``links``.

    Each round hooks every node's neighbours to the smallest of them, once over
    larger and once over smaller neighbours; groups are never collected, only
    their minimum. Rounds grow with the logarithm of the longest path.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialise(edges.distinct(), "edges")
    now, before = state(edges), None
    while now != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = materialise(large.distinct(), "large")
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(lowest.select("u", F.col("low").alias("v")))
        edges = materialise(small.distinct(), "edges")
        now, before = state(edges), now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def simhash_components(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    Null is an empty text; texts without words have fingerprint zero and link
    like any other. The component is the smallest id reachable over links of at
    most ``max_bits`` differing bits; null ids count for links but are never the
    smallest (a component of null ids only has a null id). Repeated rows are
    repeated in the result. An empty table gives no rows.
    """
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marks = materialise(with_fingerprints(rows, "text", shingle).drop("text"), "fingerprints")
    distinct = materialise(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    reached = components(near_links(distinct.select("fp"), max_bits))
    rooted = distinct.join(reached.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialise(rooted.join(least, "root").select("fp", "component_id"), "classes")
    return marks.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``df`` that stay, one of each component, all columns: the
    smallest id (null ids last), then the smallest text."""
    fp, rows = free_name(df, "fp"), free_name(df, "rows")
    # Written: the texts are hashed once, though the rows are read three times.
    tagged = materialise(with_fingerprints(df, text, shingle, fp), "tagged")
    counts = materialise(tagged.groupBy(F.col(fp).alias("fp")).agg(F.count("*").alias("n")), "fingerprints")
    reached = components(near_links(counts.select("fp"), max_bits))
    rooted = counts.join(reached.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    sizes = rooted.groupBy("root").agg(F.sum("n").alias("rows")).filter("rows > 1")
    copied = materialise(rooted.join(sizes, "root").select("fp", "root"), "copied")
    marked = tagged.join(copied.select(F.col("fp").alias(fp), F.col("root").alias(rows)), fp, "left")
    order = F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col(text).isNull(), F.col(text))
    best = marked.filter(F.col(rows).isNotNull()).groupBy(rows).agg(F.min_by(F.struct(*df.columns), order).alias("row"))
    return marked.filter(F.col(rows).isNull()).select(*df.columns).unionByName(best.select("row.*"))
