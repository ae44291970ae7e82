"""Quality classifier: random-indexing word vectors pooled per document, then a
two-layer network whose probabilities are calibrated by a temperature.

Every word bucket has a fixed sparse random index vector; its word vector is the
sum of the index vectors of its neighbours over the whole corpus. A document is
the mean and spread of its words' vectors, and the network reads that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.llm.common import append_columns, hash_runs, segment_sums, slices, texts_of, with_fields

# Words fall into buckets by hash, so the table of vectors has a fixed size of
# BUCKETS x DIMENSIONS numbers, 4 MB, whatever the vocabulary.
BUCKETS = 1 << 15
DIMENSIONS = 32
# Entries of +1 or -1 in an index vector.
ENTRIES = 4
# Neighbours on either side.
REACH = 2
# Labelled documents that the network is fitted on at most (those of the
# smallest id hashes); the word vectors are counted over all documents.
SAMPLE = 20_000
HIDDEN = 32
THRESHOLD = 0.7
SEED = 42
RUN_BYTES = 2_000_000
# Bytes that are split into words at a time, and words whose vectors are added up at a time.
BLOCK, POOLED = 200_000, 1 << 15

SPACE, MARK, LETTER = 0, 1, 2


def byte_kinds() -> np.ndarray:
    """White space, punctuation, or part of a word (letters, digits, all of UTF-8's other bytes)."""
    kinds = np.full(256, LETTER, np.uint8)
    for b in range(128):
        c = chr(b)
        kinds[b] = SPACE if c in " \t\n\v\f\r" else LETTER if c.isalnum() else MARK
    return kinds


KINDS = byte_kinds()


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's index vector; the same in every process."""
    rng = np.random.default_rng(SEED)
    places = np.argsort(rng.random((BUCKETS, DIMENSIONS)), axis=1)[:, :ENTRIES]
    return places.astype(np.int64), rng.choice([-1.0, 1.0], (BUCKETS, ENTRIES))


def token_parts(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """(from, to) of parts of BLOCK bytes or so, cut where no word or run of marks is
    cut; one that is longer makes a part of its own."""
    at = 0
    while at < len(data):
        to = min(at + BLOCK, len(data))
        while to < len(data):
            kinds = KINDS[data[at : to + 1]]
            change = np.flatnonzero(kinds[1:] != kinds[:-1])
            if len(change):
                to = at + int(change[-1]) + 1
                break
            to = min(to + BLOCK, len(data))
        yield at, to
        at = to


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and punctuation runs of all texts, and how many each has."""
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([*coded, b""]), np.uint8)
    buckets, places = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for at, to in token_parts(data):
        part = data[at:to]
        kinds = KINDS[part]
        change = np.flatnonzero(np.diff(kinds)) + 1
        starts, ends = np.concatenate([[0], change]), np.concatenate([change, [len(part)]])
        solid = kinds[starts] != SPACE
        starts, ends = starts[solid], ends[solid]
        buckets.append((hash_runs(part, starts, ends) >> np.uint64(49)).astype(np.int32))
        places.append(starts + at)
    limits = np.cumsum([len(c) + 1 for c in coded]) if coded else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(np.concatenate(places), limits), prepend=0)
    return np.concatenate(buckets), counts


def word_vectors(df: DataFrame, text: str) -> np.ndarray:
    """(BUCKETS, DIMENSIONS): unit word vectors over every document.

    A task sends one row per bucket it met, so what is shuffled and what reaches
    the driver is bounded by the table's size per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total = np.zeros(BUCKETS * DIMENSIONS)
        for batch in batches:
            for part in slices(batch, text, RUN_BYTES):
                words, counts = tokens(texts_of(part, text))
                words = words.astype(np.int64)
                owner = np.repeat(np.arange(len(counts)), counts)
                for gap in range(1, REACH + 1):
                    same = owner[gap:] == owner[:-gap]
                    for here, near in ((words[gap:], words[:-gap]), (words[:-gap], words[gap:])):
                        row, other = here[same] * DIMENSIONS, near[same]
                        for entry in range(ENTRIES):
                            at = row + places[other, entry]
                            total += np.bincount(at, weights=signs[other, entry], minlength=len(total))
        table = total.reshape(BUCKETS, DIMENSIONS)
        met = np.flatnonzero(table.any(axis=1))
        values = pa.FixedSizeListArray.from_arrays(pa.array(table[met].ravel()), DIMENSIONS).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), values], names=["bucket", "vector"])

    partial = df.select(text).mapInArrow(run, "bucket int, vector array<double>")
    sums = partial.groupBy("bucket").agg(*[F.sum(F.get("vector", F.lit(i))).alias(f"v{i}") for i in range(DIMENSIONS)]).toArrow()
    table = np.zeros((BUCKETS, DIMENSIONS))
    if sums.num_rows:
        table[sums.column("bucket").to_numpy()] = np.stack([sums.column(f"v{i}").to_numpy() for i in range(DIMENSIONS)], axis=1)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def pool(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the words' vectors and the logarithm of their number."""
    words, counts = tokens(texts)
    sums = np.zeros((2, len(texts), vectors.shape[1]))
    ends = np.cumsum(counts)
    for at in range(0, len(words), POOLED):
        to = min(at + POOLED, len(words))
        # Words of each text within this block.
        own = np.clip(ends, at, to) - np.clip(ends - counts, at, to)
        some = np.flatnonzero(own)
        found = vectors[words[at:to]]
        sums[0, some] += segment_sums(found, own[some])
        sums[1, some] += segment_sums(found * found, own[some])
    n = np.maximum(counts, 1)[:, None]
    mean = sums[0] / n
    spread = np.sqrt(np.maximum(sums[1] / n - mean * mean, 0))
    return np.concatenate([mean, spread, np.log1p(counts)[:, None]], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class Network:
    """Features to hidden units to one logit, fitted by Adam on whole batches."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, rounds: int = 300, rate: float = 0.01, decay: float = 1e-4):
        rng = np.random.default_rng(SEED)
        self.shift, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.base = float(np.log(max(y.sum(), 0.5) / max((1 - y).sum(), 0.5)))
        self.weights = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        self.temperature = 1.0
        z = (x - self.shift) / self.scale
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        for step in range(1, rounds + 1):
            a, b, c, d = self.weights
            h = np.tanh(z @ a + b)
            gap = (sigmoid(h @ c + d + self.base) - y) / len(y)
            back = np.outer(gap, c) * (1 - h * h)
            slopes = [z.T @ back + decay * a, back.sum(axis=0), h.T @ gap + decay * c, np.array([gap.sum()])]
            for w, s, m, v in zip(self.weights, slopes, first, second, strict=True):
                m += 0.1 * (s - m)
                v += 0.001 * (s * s - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh((x - self.shift) / self.scale @ a + b) @ c + d + self.base

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature of the least cross-entropy on documents not fitted on."""
        logits = self.logits(x)

        def loss(t: float) -> float:
            p = np.clip(sigmoid(logits / t), 1e-9, 1 - 1e-9)
            return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

        self.temperature = min(np.geomspace(0.25, 8, 61), key=loss)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


class Constant:
    """What remains where the labels have no two classes: their share, one half without any."""

    def __init__(self, y: np.ndarray):
        self.value = (float(y.sum()) + 0.5) / (len(y) + 1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def fit(df: DataFrame, labels: DataFrame, vectors: np.ndarray, doc_id: str, text: str, quality: str, sample: int):
    """The network for (doc_id, quality) labels; a fifth of the sample calibrates it."""
    # One label per id, and a bounded number of them: small enough to broadcast.
    known = labels.filter(F.col(quality).isNotNull() & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("_id")).agg((F.avg(quality) >= 0.5).cast("int").alias("_label"))
    chosen = known.orderBy(F.xxhash64(F.col("_id").cast("string")), "_id").limit(sample)
    shared = df.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", RUN_BYTES):
                x = pool(texts_of(part, "text"), shared.value)
                values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), values], names=["id", "label", "x"])

    rows = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("id") == F.col("_id")
    ).select(F.col("id").cast("string").alias("id"), F.col("_label").alias("label"), "text")
    # An id may repeat: one row of each, so the driver gets no more than the sample.
    one = rows.mapInArrow(run, "id string, label int, x array<double>").groupBy("id").agg(F.min("label").alias("label"), F.min("x").alias("x"))
    table = one.toPandas().sort_values("id")
    y = table["label"].to_numpy(np.float64)
    if len(set(y)) < 2:
        return Constant(y)
    x = np.array(table["x"].tolist())
    part = np.random.default_rng(SEED).permutation(len(y)) % 5 == 0
    if len(set(y[~part])) < 2:
        return Constant(y)
    network = Network(x[~part], y[~part])
    if len(set(y[part])) == 2:
        network.calibrate(x[part], y[part])
    return network


def score_quality(
    df: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text",
    quality: str = "quality", score: str = "score", sample: int = SAMPLE,
) -> DataFrame:
    """The rows with ``score``, the probability of quality 1, from the text alone.

    Learns the labels where ``learn`` (over the id) holds. Null texts count as
    empty and get a score like any other. An id labelled more than once has the
    majority's label, 1 in a tie; null ids and labels teach nothing. Labels of
    one class, or none, give a constant. Repeated rows score alike; an empty table
    gives no rows. A long text is split into words by parts, so a task holds a few
    numbers per word of it. All other columns pass through; one called like the new
    one is an error.
    """
    vectors = word_vectors(df, text)
    model = fit(df, labels.filter(learn), vectors, doc_id, text, quality, sample)
    shared = df.sparkSession.sparkContext.broadcast((vectors, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, network = shared.value
        for batch in batches:
            for part in slices(batch, text, RUN_BYTES):
                yield append_columns(part, [pa.array(network.probability(pool(texts_of(part, text), table)))], [score])

    return df.mapInArrow(run, with_fields(df.schema, [(score, T.DoubleType())]))
