"""Merkle manifest of a dataset: a hash tree per group, and one over the groups' roots.

A level of an aligned block of nodes is one hex string, a digest every 64
characters. Fixed-width substrings are hashed into the next level, and the
substrings on either side of a node are its sibling segments. What a block comes
down to is a node of the next stage, which does the same with blocks of blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import materialise

# Children of a node.
FAN = 16
# Leaves of a block: it keeps two levels below its own node.
BLOCK = FAN * FAN
# Hex digits of a digest.
WIDTH = 64


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """The digest of a row: ``-`` for a null, else UTF-8 length, ``:`` and value, so
    that no two rows with different values are written alike."""

    def field(value: Column) -> Column:
        written = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))

    return digest(*[field(v) for v in values])


def parents(level: Column) -> Column:
    """The level above, from runs of ``FAN`` digests; the last run may be shorter."""
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / (WIDTH * FAN)).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * (WIDTH * FAN) + 1, F.lit(WIDTH * FAN)), 256)), "")


def siblings(level: Column, at: Column) -> Column:
    """(left, right): the digests of the run before and behind place ``at``."""
    run = F.floor(at / FAN).cast("int") * FAN
    return F.struct(
        F.substring(level, run * WIDTH + 1, (at - run) * WIDTH).alias("left"),
        F.substring(level, at * WIDTH + (WIDTH + 1), (run + (FAN - 1) - at) * WIDTH).alias("right"),
    )


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its sibling segments give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def proof(path: Column) -> Column:
    """All siblings level by level, left to right, as one string."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with ``place`` (from 0, by ``order``) and ``size`` within their group.

    The rows are range-partitioned; a group's rows follow one another in every
    range, so a place is the place in the range plus the group's rows in earlier
    ranges, of which there is one count per range and group. Equal rows are told
    apart by a random number: however often a row is repeated, it spreads.
    """
    keys = [group, *order, "_tie"]
    sorted_rows = (
        rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id())
    )
    ranges = materialise(sorted_rows.drop("_tie"), "ranges")
    counts = ranges.groupBy(group, "_range").agg(F.count("*").alias("n"), F.min("_row").alias("_first"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        group,
        "_range",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("n").over(whole).alias("size"),
    )
    placed = ranges.join(offsets, [group, "_range"]).withColumn("place", F.col("_row") + F.col("_shift"))
    return placed.drop("_range", "_row", "_shift")


def climb(nodes: DataFrame, largest: int) -> DataFrame:
    """(key, row, path, top) from (key, place, size, node, row): each node's sibling
    segments up to its group's top node. ``largest`` is the largest size."""
    items = F.sort_array(F.collect_list(F.struct("place", "node", "row")))
    blocks = nodes.groupBy("key", F.floor(F.col("place") / BLOCK).alias("block")).agg(items.alias("items"), F.max("size").alias("size"))
    blocks = blocks.withColumn("level0", F.array_join("items.node", ""))
    blocks = blocks.withColumn("level1", F.when(F.col("size") > 1, parents(F.col("level0"))))
    blocks = blocks.withColumn("level2", F.when(F.col("size") > FAN, parents(F.col("level1"))))
    blocks = blocks.withColumn("node", F.coalesce("level2", "level1", "level0"))
    if largest > BLOCK:
        blocks = materialise(blocks, "blocks")
        above = blocks.filter(F.col("size") > BLOCK).select(
            "key",
            F.col("block").alias("place"),
            F.ceil(F.col("size") / BLOCK).alias("size"),
            "node",
            F.col("block").alias("row"),
        )
        above = climb(above, -(-largest // BLOCK)).select("key", F.col("row").alias("block"), F.col("path").alias("upper"), "top")
        blocks = blocks.join(above, ["key", "block"], "left")
    else:
        blocks = blocks.withColumns({"upper": F.lit(None).cast("array<struct<left:string,right:string>>"), "top": F.lit(None).cast("string")})

    def steps(i: Column) -> Column:
        # Only levels that have more than one node; an even smaller tree has fewer.
        two = F.array(siblings(F.col("level0"), i), siblings(F.col("level1"), F.floor(i / FAN).cast("int")))
        one = F.array(siblings(F.col("level0"), i))
        return F.when(F.col("size") > FAN, two).when(F.col("size") > 1, one).otherwise(F.slice(one, 1, 0))

    paths = F.transform(F.col("items"), lambda item, i: F.struct(item["row"].alias("row"), steps(i).alias("path")))
    found = blocks.select("key", "upper", F.coalesce("top", "node").alias("top"), F.explode(paths).alias("item"))
    path = F.when(F.col("upper").isNull(), F.col("item.path")).otherwise(F.concat("item.path", "upper"))
    return found.select("key", F.col("item.row").alias("row"), path.alias("path"), "top")


def largest_of(rows: DataFrame) -> int:
    return rows.agg(F.max("size")).first()[0] or 0


def manifest(rows: DataFrame, group: str = "source", order: str = "doc_id", leaf: str = "leaf") -> DataFrame:
    """The rows with ``subroot`` (of the group's tree), ``root`` and ``path``, the
    (left, right) sibling segments of every level from the leaf up to the root.

    Leaves ascend by ``order`` within their group, nulls first, equal ids by leaf.
    Groups ascend by name, null first. Every ``FAN`` consecutive nodes, the last run
    fewer, become one, until one is left; a lone leaf is its group's subroot.
    Repeated rows are leaves each. An empty table gives no rows. Columns called
    ``subroot``, ``root`` or ``path`` are an error.

    ``rows`` should hold digests rather than texts: they are shuffled. No task holds
    a group: it holds blocks of ``BLOCK`` rows, and a group's counts by range.
    """
    clash = {"subroot", "root", "path"} & {c.lower() for c in rows.columns}
    if clash:
        raise ValueError(f"there are columns {sorted(clash)} already")
    # Sorts like the group itself, and is never null.
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    nodes = rows.select(key.alias("key"), F.col(order).alias("order"), F.col(leaf).alias("node"), F.struct(*rows.columns).alias("row"))
    nodes = materialise(numbered(materialise(nodes, "leaves"), "key", ["order", "node"]), "nodes")
    trees = materialise(climb(nodes.select("key", "place", "size", "node", "row"), largest_of(nodes)), "trees")

    tops = trees.groupBy("key").agg(F.first("top").alias("node"))
    tops = tops.select(F.lit(0).alias("one"), F.col("key").alias("name"), "node")
    tops = materialise(numbered(tops, "one", ["name"]), "tops")
    crown = climb(tops.select(F.col("one").alias("key"), "place", "size", "node", F.col("name").alias("row")), largest_of(tops))
    crown = crown.select(F.col("row").alias("key"), F.col("path").alias("upper"), F.col("top").alias("root"))
    return trees.join(crown, "key").select(
        "row.*", F.col("top").alias("subroot"), "root", F.concat("path", "upper").alias("path")
    )
