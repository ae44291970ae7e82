"""Nearest neighbours by cosine: a vantage-point tree per shard.

On unit vectors the Euclidean distance orders like the cosine and obeys the
triangle inequality. A subtree whose distances to its vantage point lie in
[low, high] has nothing nearer to the query than ``low - d`` or ``d - high``, d
being the query's distance to that point; it is skipped if this bound, times a
factor, is beyond the best found so far. Factor one skips nothing that matters;
a larger factor skips more and may miss a neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import materialise

NEIGHBOURS = 5
LEAF = 256
# One is exact.
FACTOR = 1.0
# Vectors per shard and queries per block, about.
SHARD_ROWS = 16_384
BLOCK_ROWS = 1024
# Numbers of the largest array of candidates, which bounds a task's memory.
PART = 1 << 22


def grow(unit: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes) of a tree over unit vectors: order lists the rows so that
    each leaf is a run of it. A node is (vantage row, low and high of the inner
    side, low and high of the outer side, inner child, outer child), a leaf
    (-1, start, end, 0, ...)."""
    rng = np.random.default_rng(0)
    order: list[np.ndarray] = []
    nodes: list[list[float]] = []
    placed = 0

    def add(rows: np.ndarray) -> int:
        nonlocal placed
        at = len(nodes)
        nodes.append([-1.0, placed, placed + len(rows), 0, 0, 0, 0])
        if len(rows) > leaf:
            vantage = rows[rng.integers(len(rows))]
            far = np.sqrt(np.maximum(((unit[rows] - unit[vantage]) ** 2).sum(axis=1), 0))
            inside = far <= np.median(far)
            # Where most distances are equal a side may be next to empty: no
            # split, as the depth would grow with the rows.
            if 8 * np.count_nonzero(~inside) >= len(rows):
                near, beyond = far[inside], far[~inside]
                bounds = [near.min(), near.max(), beyond.min(), beyond.max()]
                nodes[at] = [float(vantage), *bounds, add(rows[inside]), add(rows[~inside])]
                return at
        order.append(rows)
        placed += len(rows)
        return at

    add(np.arange(len(unit)))
    return np.concatenate(order), np.array(nodes)


def search(
    unit: np.ndarray, nodes: np.ndarray, order: np.ndarray, queries: np.ndarray,
    single: np.ndarray, name: np.ndarray, own: np.ndarray, k: int, factor: float,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, row), in parts of bounded size, each pair once: with factor one
    they hold every row whose cosine may be among the query's k best, all ties
    included. All queries go down the tree together and leave a branch one by one.

    A row that is ``single``, has one id, is no answer to the query if its ``name``
    is the query's ``own``, and does not count for the k.
    """
    dim = unit.shape[1]
    # Bounds of the rounding in a product of unit vectors and in a distance.
    slack = 8 * (dim + 8) * np.finfo(np.float64).eps
    best = np.full((len(queries), k), -np.inf)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    waiting = 0

    def flush() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        at, hit, cosine = (np.concatenate(x) for x in zip(*held, strict=True))
        near = np.flatnonzero(cosine >= best[at, -1] - slack)
        for i in range(0, len(near), max(1, PART // dim)):
            part = near[i : i + max(1, PART // dim)]
            yield at[part], hit[part]

    leaves, single, name = unit[order], single[order], name[order]
    stack = [(0, np.arange(len(queries)), np.zeros(len(queries)))]
    while stack:
        node, active, bound = stack.pop()
        active = active[1 - np.maximum(bound * factor - slack, 0) ** 2 / 2 >= best[active, -1] - slack]
        if not len(active):
            continue
        kind = nodes[node]
        if kind[0] < 0:
            # A leaf of many equal distances can be long, so it is taken in runs.
            for start in range(int(kind[1]), int(kind[2]), LEAF):
                end = min(start + LEAF, int(kind[2]))
                cosine = queries[active] @ leaves[start:end].T
                better = (cosine >= best[active, -1:] - slack).any(axis=1)
                who, cosine = active[better], cosine[better]
                counted = np.where(single[start:end] & (name[start:end] == own[who][:, None]), -np.inf, cosine)
                both = np.concatenate([best[who], counted], axis=1)
                best[who] = -np.sort(np.partition(-both, k - 1, axis=1)[:, :k], axis=1)
                i, j = np.nonzero(cosine >= best[who, -1:] - slack)
                held.append((who[i], order[start + j], cosine[i, j]))
                waiting += len(i)
                if waiting > PART // 8:
                    yield from flush()
                    held, waiting = [], 0
            continue
        d = np.sqrt(np.maximum(((queries[active] - unit[int(kind[0])]) ** 2).sum(axis=1), 0))
        inner = np.maximum(np.maximum(kind[1] - d, d - kind[2]), 0)
        outer = np.maximum(np.maximum(kind[3] - d, d - kind[4]), 0)
        first = inner <= outer
        for side, near, near_bound, later, later_bound in (
            (first, int(kind[5]), inner, int(kind[6]), outer), (~first, int(kind[6]), outer, int(kind[5]), inner)
        ):
            if side.any():
                stack.append((later, active[side], later_bound[side]))
                stack.append((near, active[side], near_bound[side]))
    if held:
        yield from flush()


def usable(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v, dim) of the vectors that take part."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
    return rows.withColumn("dim", F.size("v"))


def matrix(blob: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(blob, np.float64).reshape(-1, dim)


def lengths(v: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", v, v))


def nearest(
    df: DataFrame, every: int = 50, k: int = NEIGHBOURS, vec_id: str = "vec_id", embedding: str = "embedding",
    factor: float = FACTOR, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by cosine of every row whose
    id is divisible by ``every``, against all rows with another id.

    Vectors that are null, zero, or hold null or non-finite components take no
    part, nor do rows without an id; vectors of another length are never
    compared. Ties go to the smaller id, however many there are. Equal vectors of
    a shard are one tree entry with its 2k first rows by id, at most k of an id:
    without the query's own id k are left, which is all that can be asked for. A
    query row that occurs twice is answered twice; fewer than k candidates give
    fewer rows, an empty table none.

    Queries meet all shards in blocks: a shard's tree is sent once, a block once
    per shard, and each pair gives k rows per query.
    """
    rows = materialise(usable(df, vec_id, embedding), "vectors")
    asked = rows.filter(F.pmod(F.col("vec_id"), F.lit(every)) == 0)
    n, q = rows.count(), asked.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-q // block_rows))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        v, ids = np.array(pdf["v"].tolist(), np.float64) + 0.0, pdf["vec_id"].to_numpy()
        by_vector = np.lexsort((ids, *v.T))
        v, ids = v[by_vector], ids[by_vector]
        new = np.concatenate([[True], (v[1:] != v[:-1]).any(axis=1)])
        group = np.cumsum(new) - 1
        # The same id twice in a group is the same answer twice: rows are rows.
        run = np.flatnonzero(np.concatenate([[True], new[1:] | (ids[1:] != ids[:-1])]))
        copy = np.arange(len(ids)) - np.repeat(run, np.diff(np.append(run, len(ids))))
        some = copy < k
        in_group = np.cumsum(some) - 1
        place = in_group - in_group[np.flatnonzero(new)][group]
        kept = np.full((group[-1] + 1, 2 * k), -1, np.int64)
        known = np.full(kept.shape, False)
        some &= place < 2 * k
        kept[group[some], place[some]] = ids[some]
        known[group[some], place[some]] = True
        distinct = v[new]
        order, nodes = grow(distinct / lengths(distinct)[:, None])
        return pd.DataFrame({
            "dim": [v.shape[1]], "shard": [pdf["shard"].iloc[0]], "vectors": [distinct.tobytes()], "ids": [kept.tobytes()],
            "known": [known.tobytes()], "nodes": [nodes.tobytes()], "places": [order.astype(np.int64).tobytes()],
        })

    shard = F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int")
    trees = rows.withColumn("shard", shard).groupBy("dim", "shard").applyInPandas(
        build, "dim int, shard int, vectors binary, ids binary, known binary, nodes binary, places binary"
    )

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.array(pdf["v"].tolist(), np.float64)
        return pd.DataFrame({
            "dim": [v.shape[1]], "block": [pdf["block"].iloc[0]], "queries": [v.tobytes()],
            "query_ids": [pdf["vec_id"].to_numpy().tobytes()],
        })

    # Written, as the number a row gets must not change between uses.
    block = F.pmod(F.xxhash64("vec_id", "v", F.lit("block")), F.lit(blocks)).cast("int")
    asked = asked.withColumn("block", block).groupBy("dim", "block").applyInPandas(
        gather, "dim int, block int, queries binary, query_ids binary"
    )
    pairs = materialise(asked, "queries").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    # The size that the optimizer sees is that of the blocks before they are repeated per
    # shard, so it would broadcast them, and with them a copy for every shard.
    pairs = pairs.join(trees.hint("merge"), ["dim", "shard"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = {name: batch.column(name)[r].as_py() for name in batch.schema.names}
                v, queries = matrix(get["vectors"], get["dim"]), matrix(get["queries"], get["dim"])
                ids = np.frombuffer(get["ids"], np.int64).reshape(-1, 2 * k)
                known = np.frombuffer(get["known"], bool).reshape(-1, 2 * k)
                query_ids = np.frombuffer(get["query_ids"], np.int64)
                long, query_long = lengths(v), lengths(queries)
                single = ~(known & (ids != ids[:, :1])).any(axis=1)
                at, score, own = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
                for query, hit in search(
                    v / long[:, None], np.frombuffer(get["nodes"], np.float64).reshape(-1, 7),
                    np.frombuffer(get["places"], np.int64), queries / query_long[:, None],
                    single, ids[:, 0], query_ids, k, factor,
                ):
                    cosine = np.einsum("ij,ij->i", queries[query], v[hit]) / (query_long[query] * long[hit])
                    i, j = np.nonzero(known[hit] & (ids[hit] != query_ids[query][:, None]))
                    at, score, own = (
                        np.concatenate(x) for x in ((at, query[i]), (score, cosine[i]), (own, ids[hit[i], j]))
                    )
                    sort = np.lexsort((own, -score, at))
                    at, score, own = at[sort], score[sort], own[sort]
                    top = np.arange(len(at)) - np.searchsorted(at, at) < k
                    at, score, own = at[top], score[top], own[top]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([get["block"]] * len(at), pa.int32()), pa.array(at), pa.array(query_ids[at]),
                        pa.array(own), pa.array(score), pa.array([get["dim"]] * len(at), pa.int32()),
                    ],
                    names=["block", "at", "query_id", "vec_id", "score", "dim"],
                )

    answers = pairs.mapInArrow(answer, "block int, at long, query_id long, vec_id long, score double, dim int")
    best = Window.partitionBy("dim", "block", "at").orderBy(F.desc("score"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
