"""Packing documents into training sequences of a fixed number of tokens.

Every document is cut into full windows, each a sequence of its own, and a tail.
Tails are counted by length class. A non-negative least-squares fit finds how
often each shallow combination of classes that fills a window exactly has to be
repeated to use the histogram up; the counts are rounded, and what is left is
packed greedily, cutting a tail where nothing fits. All of this happens on the
histogram, whose size the window bounds; the tails find their places by their
rank within their class.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.bpe import WORDS, Trie, Vocabulary, unknown_letters, vocabulary_of
from ontime.llm.common import materialise, slices, texts_of

WINDOW = 1024
# Tail lengths are counted in classes of this many tokens; a packed tail leaves
# less than one class width of padding.
UNIT = 4
# Classes in one combination at most.
DEPTH = 3
END_ID = 0
# Sequences of full windows are numbered above all others, by task.
TASK_SHIFT = 38
# Ranks within a class stay below this.
RANKS = 1 << 45


@cache
def encoder(content: str) -> tiktoken.Encoding:
    """The same tokens as the tokenizers library gives for this file, faster."""
    v = Vocabulary(content)
    return tiktoken.Encoding("packing", pat_str=WORDS, mergeable_ranks=v.id_of, special_tokens=v.added)


class Encoder:
    """Ids of a text; what the fast encoder cannot split, a million blanks in a row,
    goes along the trie, whose tables are made when such a text is met."""

    def __init__(self, content: str):
        self.fast, self.content, self.trie = encoder(content), content, None

    def ids(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            self.trie = self.trie or Trie(vocabulary_of(self.content, unknown_letters()))
            return np.frombuffer(self.trie.encode(text), "<u4")


def combinations(units: int, depth: int) -> list[tuple[int, ...]]:
    """Multisets of at most ``depth`` class sizes that add up to ``units``."""
    out: list[tuple[int, ...]] = []

    def extend(chosen: tuple[int, ...], rest: int, most: int) -> None:
        if not rest:
            out.append(chosen)
        elif len(chosen) < depth:
            for size in range(min(rest, most), 0, -1):
                if size * (depth - len(chosen)) < rest:
                    break
                extend((*chosen, size), rest - size, size)

    extend((), units, units)
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int) -> np.ndarray:
    """x >= 0 with the least ``|a x - b|``, by the active-set method."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-7 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= tolerance:
            break
        active[best] = True
        while True:
            chosen = np.flatnonzero(active)
            fit = np.linalg.lstsq(a[:, chosen], b, rcond=None)[0]
            if fit.min() > 0:
                x[:] = 0
                x[chosen] = fit
                break
            here = x[chosen]
            down = fit <= 0
            step = (here[down] / np.maximum(here[down] - fit[down], 1e-300)).min()
            x[chosen] = here + step * (fit - here)
            active[chosen[x[chosen] <= tolerance]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


class Plan:
    """Places for the tails of each class by rank: runs of ranks that go to the
    same slot of successive sequences, whole or cut."""

    def __init__(self, histogram: dict[int, int], units: int, depth: int = DEPTH):
        self.units, self.sequences = units, 0
        self.given = Counter()  # ranks handed out per class
        self.total = Counter({k: n for k, n in histogram.items() if n})  # ranks there are
        self.runs: list[tuple[int, int, int, int, int, int, int]] = []
        self.fit(depth)
        while left := {k: n for k in self.total if (n := self.total[k] - self.given[k])}:
            self.greedy(left)

    def fit(self, depth: int) -> None:
        table = combinations(self.units, depth)
        shape = np.zeros((self.units, len(table)))
        for j, sizes in enumerate(table):
            for size in sizes:
                shape[size - 1, j] += 1
        wanted = np.array([self.total[k + 1] for k in range(self.units)], float)
        repeats = nnls(shape, wanted, 3 * self.units)
        for j in np.argsort(-repeats, kind="stable"):
            if repeats[j] < 0.5:
                break
            need = Counter(table[j])
            most = min((self.total[k] - self.given[k]) // m for k, m in need.items())
            if n := min(round(repeats[j]), most):
                self.place([(size, 0) for size in table[j]], n)

    def greedy(self, left: dict[int, int]) -> None:
        """One pattern: the largest tails that fit, and if none does the head of
        the smallest one beyond, repeated as often as the classes allow."""
        pattern, used, room = [], Counter(), self.units
        sizes = sorted(left, reverse=True)
        while room:
            free = [k for k in sizes if left[k] > used[k]]
            fitting = next((k for k in free if k <= room), None)
            if fitting is None and not free:
                break
            size, cut = (fitting, 0) if fitting else (free[-1], room)
            pattern.append((size, cut))
            used[size] += 1
            room -= cut or size
        self.place(pattern, min(left[k] // m for k, m in used.items()))

    def place(self, pattern: list[tuple[int, int]], n: int) -> None:
        for slot, (size, cut) in enumerate(pattern):
            rest = size - cut if cut else 0
            self.runs.append((size, self.given[size], self.sequences, slot, cut, rest, self.total[rest] if cut else 0))
            self.given[size] += n
            if cut:
                self.total[rest] += n
        self.sequences += n

    def arrays(self) -> tuple[np.ndarray, ...]:
        """The runs by class and first rank; their number depends on the window only."""
        table = np.array(sorted(self.runs), np.int64).reshape(-1, 7)
        return (table[:, 0] * RANKS + table[:, 1], *table.T)


def tokenise(df: DataFrame, vocabulary_path: str, doc_id: str, text: str, window: int, unit: int) -> DataFrame:
    """Per document: its tokens, the checksums of its full windows, its tail, and
    the tail's class and rank within class and task. Written, so that tasks and
    ranks stay as they are whatever happens later."""
    with open(vocabulary_path, encoding="utf-8") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(content.value).ids
        task, ranks, windows = TaskContext.get().partitionId(), Counter(), 0
        for batch in batches:
            for part in slices(batch, text):
                rows: dict[str, list] = {k: [] for k in ("tokens", "full", "first", "tail", "class", "rank")}
                for t in texts_of(part, text):
                    ids = np.append(encode(t), END_ID).astype("<u4")
                    n = len(ids) // window
                    size = -(-(len(ids) - n * window) // unit)
                    rows["tokens"].append(len(ids))
                    rows["full"].append([zlib.crc32(ids[i * window : (i + 1) * window]) for i in range(n)])
                    rows["first"].append(windows)
                    rows["tail"].append(ids[n * window :].tobytes())
                    rows["class"].append(size)
                    rows["rank"].append(ranks[size])
                    windows += n
                    ranks[size] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(doc_id),
                        pa.array([task] * part.num_rows, pa.int64()),
                        pa.array(rows["tokens"], pa.int64()),
                        pa.array(rows["full"], pa.list_(pa.int64())),
                        pa.array(rows["first"], pa.int64()),
                        pa.array(rows["tail"], pa.binary()),
                        pa.array(rows["class"], pa.int32()),
                        pa.array(rows["rank"], pa.int64()),
                    ],
                    names=["doc_id", "task", "tokens", "full", "first", "tail", "class", "rank"],
                )

    kind = df.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, task long, tokens long, full array<long>, first long, tail binary, class int, rank long"
    return materialise(df.select(doc_id, text).mapInArrow(run, schema), "packing")


def tail_pieces(tails: DataFrame, plan: Plan, window: int, unit: int) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, slot) of the tails."""
    shared = tails.sparkSession.sparkContext.broadcast(plan.arrays())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, _, firsts, bases, slots, cuts, rests, rest_firsts = shared.value
        for batch in batches:
            tokens = batch.column("tokens").to_numpy()
            tail = [memoryview(b) for b in batch.column("tail").to_pylist()]
            row = np.arange(batch.num_rows)
            size, rank = batch.column("class").to_numpy().astype(np.int64), batch.column("rank").to_numpy()
            done = np.zeros(batch.num_rows, np.int64)  # tokens of the tail placed so far
            whole = tokens % window
            out = []
            while len(row):
                at = np.searchsorted(keys, size * RANKS + rank, "right") - 1
                step = rank - firsts[at]
                length = np.where(cuts[at] > 0, cuts[at] * unit, whole[row] - done)
                crc = [zlib.crc32(tail[r][4 * a : 4 * b]) for r, a, b in zip(row, done, done + length, strict=True)]
                out.append((row, tokens[row] - whole[row] + done, length, np.array(crc, np.int64), bases[at] + step, slots[at]))
                more = cuts[at] > 0
                done, size, rank, row = ((x[more]) for x in (done + length, rests[at], rest_firsts[at] + step, row))
            if out:
                rows, *columns = (np.concatenate(c) for c in zip(*out, strict=True))
                start, length, crc, sequence, slot = (pa.array(c, pa.int64()) for c in columns)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows)), start, length, crc, pa.array(tokens[rows], pa.int64()), sequence, slot],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"],
                )

    kind = tails.schema["doc_id"].dataType.simpleString()
    return tails.select("doc_id", "tokens", "tail", "class", "rank").mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, slot long"
    )


def pack(
    df: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text",
    window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its tokens and an end id; null is an empty text, one piece of
    that end id. Every row is packed, whatever its id: null and repeated ids give
    as many sets of pieces as rows. Other columns are not carried. An empty table
    gives no pieces. A long text makes many full windows; a task holds its ids.

    The documents are read once and never shuffled; the class ranks of the tasks
    are added up from (task, class) counts. Only the short tails move, to find
    the offset in their sequence, and a sequence holds ``window / unit`` at most.
    """
    if window % unit:
        raise ValueError("the class width has to divide the window")
    table = tokenise(df, vocabulary_path, doc_id, text, window, unit)
    full = table.select("doc_id", "task", "first", "tokens", F.posexplode("full").alias("i", "ids_crc32")).select(
        "doc_id",
        (F.col("i") * window).cast("long").alias("start"),
        F.lit(window).cast("long").alias("length"),
        "ids_crc32",
        F.col("tokens").alias("doc_tokens"),
        (F.shiftleft(F.col("task") + 1, TASK_SHIFT) + F.col("first") + F.col("i")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )

    tails = table.filter(F.col("class") > 0)
    counts = tails.groupBy("task", "class").agg(F.count("*").alias("n"))
    # At most window / unit rows.
    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    if not histogram:
        return full
    plan = Plan(histogram, window // unit, depth)
    earlier = Window.partitionBy("class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "class", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = tails.join(before, ["task", "class"]).withColumn("rank", F.col("rank") + F.col("before"))
    pieces = tail_pieces(ranked, plan, window, unit)
    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    return full.unionByName(placed.drop("slot"))
