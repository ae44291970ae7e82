"""Exact deduplication in two passes over a Bloom filter that counts to two.

First pass: every text hash adds one to each of its cells; the cells that reached
two make the filter. Second pass: a text whose cells are not all in the filter
occurs once and passes straight through. Only the others, possibly repeated, are
grouped by their digest, which settles what really repeats.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import free_name, materialise

# Words of 64 cells in a full filter: 2^27 cells. A word is a key and a mask, so
# the filter that is broadcast has 2^21 rows of 16 bytes at most, however many
# texts there are. Beyond some hundred million texts it fills up and lets more
# rows through to the grouping; the result stays the same.
FILTER_WORDS = 1 << 21
CELLS = 64
# Cells per text, each in a word of its own.
PROBES = 2


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; null as empty.

    A lone space stays as it is, so the expression does not touch it.
    """
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*| [\x20\x09-\x0D]+", " ")


def cell(digest: Column, probe: int, words: int) -> Column:
    """(word, bit) of one probe."""
    hashed = F.xxhash64(digest, F.lit(probe))
    return F.struct(
        F.pmod(hashed, F.lit(words)).alias("word"), F.shiftrightunsigned(hashed, 58).cast("int").alias("bit")
    )


def repeat_filter(digests: DataFrame, digest: str, words: int = FILTER_WORDS) -> DataFrame:
    """(word, mask): the cells that two rows or more have hit. Written."""
    hits = digests.select(F.inline(F.array(*[cell(F.col(digest), i, words) for i in range(PROBES)])))
    twice = hits.groupBy("word", "bit").agg(F.count("*").alias("n")).filter("n > 1")
    mask = F.bit_or(F.expr("shiftleft(1L, bit)"))
    return materialise(twice.groupBy("word").agg(mask.alias("mask")), "repeats")


def possibly_repeated(df: DataFrame, digest: str, filters: DataFrame, words: int = FILTER_WORDS) -> tuple[DataFrame, str]:
    """The rows with a new boolean column, false where the digest occurs once, and
    its name. The filter is broadcast, so no row is shuffled; its row count is
    bounded by ``words``."""
    names = [free_name(df, f"{k}{i}") for i in range(PROBES) for k in ("cell", "mask")]
    out = free_name(df, "possible")
    rows = df
    for i in range(PROBES):
        at, mask = names[2 * i], names[2 * i + 1]
        rows = rows.withColumn(at, cell(F.col(digest), i, words))
        side = F.broadcast(filters.select(F.col("word").alias(f"{at}_word"), F.col("mask").alias(mask)))
        rows = rows.join(side, F.col(f"{at}.word") == F.col(f"{at}_word"), "left").drop(f"{at}_word")
    hit = [F.coalesce(F.expr(f"shiftright(`{m}`, `{a}`.bit) & 1 = 1"), F.lit(False)) for a, m in zip(names[::2], names[1::2], strict=True)]
    return rows.withColumn(out, reduce(lambda a, b: a & b, hit)).drop(*names), out


def exact_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row.

    Texts are equal when their normalised forms are; null counts as empty. Of
    equal texts the smallest id stays, null ids last. If several rows of a group
    share that id, one of them is marked as kept. An empty table gives no rows.
    """
    digests = materialise(
        df.select(F.col(doc_id).alias("doc_id"), F.sha2(normalised(F.col(text)), 256).alias("text_sha256")), "digests"
    )
    rows, possible = possibly_repeated(digests, "text_sha256", repeat_filter(digests, "text_sha256"))
    single = rows.filter(~F.col(possible)).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    # Rows that look alike become one with a count, so no group is ever sorted or collected.
    alike = materialise(
        rows.filter(possible).groupBy("text_sha256", "doc_id").agg(F.count("*").alias("n")), "alike"
    )
    # Written, so that the join below reads two plain tables and Spark can split a hot digest.
    groups = materialise(
        alike.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size")), "groups"
    )
    repeated = (
        alike.join(groups, "text_sha256")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )
    return single.unionByName(repeated)


def drop_exact_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, one of each group of equal texts, all columns.

    Rows whose digest occurs once pass straight through. Of the others only the
    best row so far of each group and task is shuffled: the smallest id, null
    ids last, then the smallest text.
    """
    digest = free_name(df, "text_sha256")
    tagged = df.withColumn(digest, F.sha2(normalised(F.col(text)), 256))
    digests = materialise(tagged.select(digest), "digests")
    marked, possible = possibly_repeated(tagged, digest, repeat_filter(digests, digest))
    order = F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col(text).isNull(), F.col(text))
    best = marked.filter(possible).groupBy(digest).agg(F.min_by(F.struct(*df.columns), order).alias("row"))
    return marked.filter(~F.col(possible)).select(*df.columns).unionByName(best.select("row.*"))
