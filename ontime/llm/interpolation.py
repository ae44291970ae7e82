"""Language-model scoring by deleted interpolation of unigrams and bigrams.

P(w | u) mixes the uniform distribution over the known words and one unknown, the
unigram estimate c(w) / N and the bigram estimate c(u w) / c(u). The weights
depend on how often the context u was seen (a bucket per power of two) and are
learned by expectation-maximisation on held-out counts: each learned document is
predicted by the counts of all others.

Tasks take documents in chunks and send each distinct word and bigram of a chunk
once, as sorted arrays of hashes by hash range; a shard adds up the counts and
answers in the same order. Counts are exact but for collisions of 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ontime.llm.common import hash_runs, materialise, mix, segment_sums, slices, texts_of
from ontime.session import new_folder

# Bytes of text in a chunk, about; one longer text is a chunk of its own.
CHUNK_BYTES = 6_000_000
# Hashes that a shard receives, about.
SHARD_HASHES = 2_000_000
SMOOTHING = 0.1
ROUNDS = 100
END = np.uint64(0xD6E8FEB86659FD93)
START = np.uint64(0xA0761D6478BD642F)
UPPER = np.arange(256, dtype=np.uint8)
UPPER[ord("A") : ord("Z") + 1] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def tokenise(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each text followed by the end token, and the
    number of tokens per text."""
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = UPPER[np.frombuffer(b" ".join([b"", *coded, b""]), np.uint8)]
    space = SPACE[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    words = hash_runs(data, starts, ends)
    limits = np.cumsum([len(c) + 1 for c in coded])
    counts = np.diff(np.searchsorted(starts, limits), prepend=0)
    out = np.empty(len(words) + len(texts), np.uint64)
    last = np.cumsum(counts + 1) - 1
    own = np.ones(len(out), bool)
    own[last] = False
    out[own], out[last] = words, END
    return out, counts + 1


def contexts(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The token before each one, the start symbol at the head of a text."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(counts) - counts] = START
    return before


def pair_hash(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9FB21C651E98DF25) ^ mix(tokens + np.uint64(0x2545F4914F6CDD1D)))


class Chunk:
    """A chunk's distinct words (and contexts) and bigrams, and where its tokens point."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, learned: np.ndarray):
        self.counts, self.owner = counts, np.repeat(np.arange(len(counts)), counts)
        before = contexts(tokens, counts)
        self.words, place = np.unique(np.concatenate([tokens, [START]]), return_inverse=True)
        self.word = place[:-1]
        self.context = np.searchsorted(self.words, before)
        self.pairs, self.pair = np.unique(pair_hash(before, tokens), return_inverse=True)
        self.learned = learned[self.owner]
        heads = np.zeros(len(self.words), np.int64)
        heads[np.searchsorted(self.words, START)] = learned.sum()
        self.word_counts = np.bincount(self.word[self.learned], minlength=len(self.words)) + heads
        self.pair_counts = np.bincount(self.pair[self.learned], minlength=len(self.pairs))

    def in_document(self, names: np.ndarray) -> np.ndarray:
        """How often each token's name occurs in its own document."""
        _, place, n = np.unique(self.owner * (int(names.max(initial=0)) + 1) + names, return_inverse=True, return_counts=True)
        return n[place]


def by_chunk(df: DataFrame, database: str) -> str:
    """Write a table in buckets by chunk and return its name."""
    name = f"{database}.chunks_{uuid.uuid4().hex}"
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, "chunk").option("compression", "zstd").saveAsTable(name)
    return name


def chunks(df: DataFrame, doc_id: str, text: str, learn: Column, database: str) -> str:
    """One row per chunk: its documents and tokens. Written in buckets by chunk,
    so that answers find their chunk without moving it; returns the table's name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                tokens, counts = tokenise(texts_of(part, "text"))
                names, codes = np.unique(tokens, return_inverse=True)
                learned = part.column("learn").to_numpy(zero_copy_only=False).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("doc_id")),
                        pa.array([learned.tobytes()], pa.binary()),
                        pa.array([counts.astype("<i4").tobytes()], pa.binary()),
                        pa.array([names.tobytes()], pa.binary()),
                        pa.array([codes.astype("<i4").tobytes()], pa.binary()),
                        pa.array([len(tokens)], pa.int64()),
                        pa.array([int(counts[learned].sum())], pa.int64()),
                    ],
                    names=["chunk", "doc_ids", "learned", "counts", "names", "codes", "tokens", "learned_tokens"],
                )
                number += 1

    kind = df.schema[doc_id].dataType.simpleString()
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    table = rows.mapInArrow(
        run, f"chunk long, doc_ids array<{kind}>, learned binary, counts binary, names binary, codes binary, "
        "tokens long, learned_tokens long"
    )
    return by_chunk(table, database)


def chunk_of(row: dict) -> Chunk:
    names = np.frombuffer(row["names"], np.uint64)
    tokens = names[np.frombuffer(row["codes"], "<i4")]
    return Chunk(tokens, np.frombuffer(row["counts"], "<i4").astype(np.int64), np.frombuffer(row["learned"], bool))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def packed(names: np.ndarray) -> bytes:
    """Rising numbers as gaps, first bytes first: the high bytes of the gaps are
    nearly all zero, which shuffle compression takes out."""
    return np.diff(names, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def ask(table: DataFrame, shards: int) -> DataFrame:
    """(shard, kind, chunk, hashes, counts): a chunk's distinct words and bigrams by
    hash range, with how often its learned documents have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.uint64(min((1 << 64) // shards + 1, (1 << 64) - 1))
        for row in rows_of(batches):
            chunk = chunk_of(row)
            for kind, names, counts in (("w", chunk.words, chunk.word_counts), ("p", chunk.pairs, chunk.pair_counts)):
                shard = (names // width).astype(np.int64)
                met, first = np.unique(shard, return_index=True)
                ends = [*first[1:].tolist(), len(names)]
                small = counts.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(met, pa.int64()),
                        pa.array([kind] * len(met), pa.string()),
                        pa.array([row["chunk"]] * len(met), pa.int64()),
                        pa.array([packed(names[a:b]) for a, b in zip(first, ends, strict=True)], pa.binary()),
                        pa.array([small[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
                    ],
                    names=["shard", "kind", "chunk", "hashes", "counts"],
                )

    columns = ["chunk", "learned", "counts", "names", "codes"]
    return table.select(*columns).mapInArrow(run, "shard long, kind string, chunk long, hashes binary, counts binary")


def answer(asked: DataFrame) -> DataFrame:
    """(chunk, kind, shard, totals, types): the counts over all chunks, in the order asked."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names = [unpacked(b) for b in pdf["hashes"]]
        counts = np.concatenate([np.frombuffer(b, "<u4") for b in pdf["counts"]]).astype(np.int64)
        distinct, place = np.unique(np.concatenate(names), return_inverse=True)
        totals = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)
        types = int(((totals > 0) & (distinct != START)).sum())
        ends = np.cumsum([0, *map(len, names)])
        blobs = [totals[place[a:b]].astype("<i8") for a, b in zip(ends[:-1], ends[1:], strict=True)]
        narrow = ["<u2" if len(b) and b.max() < 65_535 else "<i8" for b in blobs]
        return pd.DataFrame({
            "chunk": pdf["chunk"], "kind": pdf["kind"], "shard": pdf["shard"],
            "width": [int(w[-1]) for w in narrow],
            "totals": [b.astype(w).tobytes() for b, w in zip(blobs, narrow, strict=True)],
            # Each shard's number of learned types, told once.
            "types": [types if i == 0 else 0 for i in range(len(pdf))],
        })

    schema = "chunk long, kind string, shard long, width int, totals binary, types long"
    return asked.groupBy("kind", "shard").applyInPandas(run, schema)


def per_chunk(answers: DataFrame) -> DataFrame:
    """(chunk, word_totals, pair_totals, types): a chunk's answers in the order of its hashes."""
    parts = F.struct("shard", "width", "totals")
    return answers.groupBy("chunk").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "w", parts))).alias("word_totals"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "p", parts))).alias("pair_totals"),
        F.sum(F.when(F.col("kind") == "w", F.col("types"))).alias("types"),
    )


def totals_of(parts: list[dict]) -> np.ndarray:
    return np.concatenate([np.frombuffer(p["totals"], f"<{'u' if p['width'] == 2 else 'i'}{p['width']}").astype(np.int64) for p in parts])


def bucket(context_counts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two below its count."""
    return np.where(context_counts > 0, np.log2(np.maximum(context_counts, 1)).astype(np.int64) + 1, 0)


class Grid(NamedTuple):
    """The cells that EM runs on: context buckets, and cells per side of the grid of
    (unigram, bigram) estimates."""

    buckets: int
    side: int

    def cell(self, p: np.ndarray) -> np.ndarray:
        """0 for zero, else a cell per half power of two from one down."""
        return np.where(p > 0, self.side - 1 - (-2 * np.log2(np.maximum(p, 1e-300))).astype(np.int64), 0)


def grid_for(total: int) -> Grid:
    """Room for contexts of any count, and for estimates down to one in ``total``: the
    cells are as wide at every size, their number grows as the cube of its logarithm."""
    octaves = max(total, 1).bit_length()
    return Grid(octaves + 1, 2 * octaves + 2)


def deleted_counts(table: DataFrame, total: int) -> pd.DataFrame:
    """(cell, n, unigram, bigram) over all learned tokens, each predicted by the
    counts without its own document: sums per cell of (bucket, grid, grid)."""
    grid = grid_for(total)
    size = grid.buckets * grid.side * grid.side

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, size))
        for row in rows_of(batches):
            chunk = chunk_of(row)
            words, pairs = totals_of(row["word_totals"]), totals_of(row["pair_totals"])
            tokens = np.flatnonzero(chunk.learned)
            if not len(tokens):
                continue
            c2 = words[chunk.word] - chunk.in_document(chunk.word)
            c1 = words[chunk.context] - chunk.in_document(chunk.context)
            c12 = pairs[chunk.pair] - chunk.in_document(chunk.pair)
            rest = np.maximum(total - np.repeat(chunk.counts, chunk.counts), 1)
            unigram = c2 / rest
            bigram = np.where(c1 > 0, c12 / np.maximum(c1, 1), 0)
            cell = ((bucket(c1) * grid.side + grid.cell(unigram)) * grid.side + grid.cell(bigram))[tokens]
            for i, weight in enumerate((np.ones(len(tokens)), unigram[tokens], bigram[tokens])):
                sums[i] += np.bincount(cell, weights=weight, minlength=size)
        met = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int64()), *[pa.array(s[met]) for s in sums]], names=["cell", "n", "unigram", "bigram"]
        )

    cells = table.drop("doc_ids", "tokens", "learned_tokens").mapInArrow(run, "cell long, n double, unigram double, bigram double")
    return cells.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "unigram", "bigram")]).toPandas()


def learn_weights(cells: pd.DataFrame, uniform: float, grid: Grid, rounds: int = ROUNDS) -> np.ndarray:
    """(buckets, 3): weights of uniform, unigram and bigram by EM; a bucket without
    held-out tokens takes those of the bucket below. Unseen contexts have no bigram."""
    weights = np.zeros((grid.buckets, 3))
    which = cells["cell"].to_numpy() // (grid.side * grid.side)
    n = cells["n"].to_numpy()
    parts = np.stack([np.full(len(n), uniform), cells["unigram"] / n, cells["bigram"] / n], axis=1) if len(n) else np.zeros((0, 3))
    for b in range(grid.buckets):
        mask = np.array([1.0, 1.0, float(b > 0)])
        if not (which == b).any():
            weights[b] = weights[b - 1] if b > 1 else mask / mask.sum()
            continue
        p, m, w = parts[which == b], n[which == b], mask / mask.sum()
        for _ in range(rounds):
            share = p * w
            share /= share.sum(axis=1, keepdims=True)
            w = (share * m[:, None]).sum(axis=0) / m.sum()
        # Every event stays possible.
        w = np.maximum(w, 1e-6 * mask)
        weights[b] = w / w.sum()
    return weights


def score_texts(df: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score), a row per input row.

    Learns from the rows where ``learn`` holds. Null is an empty text, whose only
    token is the end. base_score is the smoothed unigram's log10 probability,
    score that of the mixture, both of the whole text. Null and repeated ids and
    repeated rows are rows like any others; with nothing to learn from every
    token is unknown. An empty table gives no rows. Other columns are not looked at,
    whatever their names. A long text is a chunk of its own, some 40 bytes of memory
    a byte.

    Two bucketed tables are made in a database of the call's own, in the shared
    folder; it is dropped at the end, also after an error.
    """
    spark = df.sparkSession
    database = f"llm_scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{new_folder(spark, 'llm_scratch')}'")
    try:
        return _score(df, learn, doc_id, text, database)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def _score(df: DataFrame, learn: Column, doc_id: str, text: str, database: str) -> DataFrame:
    spark = df.sparkSession
    name = chunks(df, doc_id, text, learn, database)
    table = spark.table(name)
    size = table.agg(F.count("*"), F.sum("tokens"), F.sum("learned_tokens")).first()
    shards = max(1, -(-int(size[1] or 0) // SHARD_HASHES))
    answers = by_chunk(per_chunk(answer(ask(table, shards))), database)
    vocabulary = int(spark.table(answers).agg(F.sum("types")).first()[0] or 0)

    total = int(size[2] or 0)
    # Both tables lie in the same buckets: neither is shuffled.
    full = table.join(spark.table(answers).drop("types").hint("shuffle_hash"), "chunk")
    uniform = 1 / (vocabulary + 1)
    weights = learn_weights(deleted_counts(full, total), uniform, grid_for(total))
    shared = spark.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = shared.value
        for row in rows_of(batches):
            chunk = chunk_of(row)
            words, pairs = totals_of(row["word_totals"]), totals_of(row["pair_totals"])
            c2, c1, c12 = words[chunk.word], words[chunk.context], pairs[chunk.pair]
            base = np.log10((c2 + SMOOTHING) / (total + SMOOTHING * (vocabulary + 1)))
            w = mixture[bucket(c1)]
            p = w[:, 0] * uniform + w[:, 1] * c2 / max(total, 1) + w[:, 2] * c12 / np.maximum(c1, 1)
            values = np.stack([(c2 > 0).astype(float), base, np.log10(p)], axis=1)
            sums = segment_sums(values, chunk.counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], to_arrow_type(id_type)),
                    pa.array(chunk.counts),
                    pa.array(sums[:, 0].astype(np.int64)),
                    pa.array([total] * len(chunk.counts), pa.int64()),
                    pa.array(sums[:, 1]),
                    pa.array(sums[:, 2]),
                ],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    id_type = df.schema[doc_id].dataType
    schema = f"doc_id {id_type.simpleString()}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return materialise(full.drop("tokens", "learned_tokens").mapInArrow(run, schema), "scores")

