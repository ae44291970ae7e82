"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.llm.common import append_columns, slices, texts_of, with_fields

BUCKETS = 1 << 16
LENGTHS = (1, 2, 3)
# Added to every count.
SMOOTHING = 0.5
# The matrix that is broadcast has this many columns at most; more labels than
# there are languages are an error in the table.
MAX_LABELS = 500
UNKNOWN = "und"
# Texts are taken in runs of about this many bytes, and looked at by so many characters.
RUN_BYTES = 1_000_000
BLOCK = 200_000
# Words with one are numbers, keys, addresses: they tell no language.
DIGIT = re.compile(r"\d")
# A text of m n-grams may be 1 + ALLOWANCE / sqrt(m) deviations off for a fit of -1.
ALLOWANCE = 4


def grams(texts: list[str], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of n-gram buckets of all texts, and how many of them each text has, in
    the order of the texts. A long text is cut into parts that overlap, so that the
    arrays are bounded by BLOCK characters whatever the texts."""
    parts: list[tuple[int, str, int]] = []  # text, characters, places where a gram may begin
    size, reach = 0, max(LENGTHS) - 1
    for i, text in enumerate(texts):
        lower = text.lower()
        for at in range(0, len(lower), BLOCK):
            parts.append((i, lower[at : at + BLOCK + reach], min(BLOCK, len(lower) - at)))
            size += parts[-1][2]
            if size >= BLOCK:
                yield from gram_block(parts, len(texts), buckets)
                parts, size = [], 0
    if parts:
        yield from gram_block(parts, len(texts), buckets)


def gram_block(parts: list[tuple[int, str, int]], texts: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for _, t, _ in parts]
    lengths = np.array([len(c) for c in codes])
    flat = np.concatenate(codes).astype(np.uint64)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    room = np.repeat(lengths, lengths) - place  # characters from here to the part's end
    begins = place < np.repeat([n for *_, n in parts], lengths)
    owner = np.repeat([i for i, *_ in parts], lengths)
    state = np.zeros(len(flat), np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        keep = np.flatnonzero(begins & (room >= n))
        state = state[: len(flat) - n + 1] if n > 1 else state
        state = state * np.uint64(0x100000001B3) + flat[n - 1 :]
        if n in LENGTHS and len(keep):
            mixed = (state[keep] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            yield (mixed >> np.uint64(40)).astype(np.int64) % buckets, np.bincount(owner[keep], minlength=texts)


def log_chances(texts: list[str], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, label) sums of the n-grams' log-probabilities, and n-grams per text."""
    total, sizes = np.zeros((len(texts), matrix.shape[1])), np.zeros(len(texts), np.int64)
    for found, counts in grams(texts):
        full = np.flatnonzero(counts)
        firsts = (np.cumsum(counts) - counts)[full]
        for j in range(matrix.shape[1]):
            total[full, j] += np.add.reduceat(matrix[:, j][found], firsts, dtype=np.float64)
        sizes += counts
    return total, sizes


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def count_grams(df: DataFrame, text: str, label: str, learn: Column) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Labels in order, documents per label, and n-gram counts (bucket, label).

    Every learned text is counted whole. A task sends one row per label and
    bucket, and the sums that reach the driver have no more than that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, text, RUN_BYTES):
                names = part.column(label).to_pylist()
                texts = texts_of(part, text)
                for name in set(names):
                    own = [t for t, m in zip(texts, names, strict=True) if m == name]
                    into = totals.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                    for found, _ in grams(own):
                        into[:BUCKETS] += np.bincount(found, minlength=BUCKETS)
                    into[BUCKETS] += len(own)  # the last entry counts documents
        for name, counts in totals.items():
            full = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(full), pa.string()), pa.array(full, pa.int32()), pa.array(counts[full])],
                names=["label", "bucket", "n"],
            )

    learned = df.filter(learn & F.col(label).isNotNull()).select(F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
    text, label = "text", "label"
    if learned.select("label").distinct().limit(MAX_LABELS + 1).count() > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels: these are no languages")
    sums = learned.mapInArrow(run, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    labels = sorted(set(table.column("label").to_pylist()))
    counts = np.zeros((BUCKETS + 1, len(labels)))
    at = np.searchsorted(np.array(labels), np.array(table.column("label").to_pylist(), dtype=str)) if labels else []
    counts[table.column("bucket").to_numpy(), at] = table.column("n").to_numpy()
    return labels, counts[BUCKETS], counts[:BUCKETS]


def identify_language(
    df: DataFrame, learn: Column, text: str = "text", label: str = "lang",
    predicted: str = "lang_pred", score: str = "score", fit: str | None = None,
) -> DataFrame:
    """The rows with the predicted language and its posterior probability.

    Learns from the rows where ``learn`` holds and the label is not null, and
    predicts from the text alone. Null texts and texts without a letter are
    ``und`` with score 0, as is every text if there is nothing to learn from.
    Equal probabilities go to the first label in order. Repeated rows count as
    often as they occur. An empty table gives no rows. Of a long text the arrays
    hold BLOCK characters at a time. All other columns pass through; one called
    like a new one is an error.

    The posterior only compares the learned languages, and is near 1 for any long
    text. ``fit`` names a column that says whether the text is of the language at
    all: how many deviations its mean log-probability per n-gram is above that of
    the language's own n-grams, scaled for short texts, words with digits left
    out. It is null for ``und``.
    """
    labels, documents, counts = count_grams(df, text, label, learn)
    weights = np.log(counts + SMOOTHING) - np.log((counts + SMOOTHING).sum(axis=0))
    prior = np.log(documents) - np.log(documents.sum()) if labels else np.zeros(0)
    chances = np.exp(weights)
    usual = (chances * weights).sum(axis=0)
    spread = np.sqrt(np.maximum((chances * weights**2).sum(axis=0) - usual**2, 1e-12))
    shared = df.sparkSession.sparkContext.broadcast((labels, prior, weights.astype(np.float32), usual, spread))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, before, matrix, middle, width = shared.value
        for batch in batches:
            for part in slices(batch, text, RUN_BYTES):
                texts = texts_of(part, text)
                best, chance, fits = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan)
                told = [i for i, t in enumerate(texts) if names and has_letter(t)]
                if told:
                    total, sizes = log_chances([texts[i] for i in told], matrix)
                    total += before
                    top = total.argmax(axis=1)
                    chance[told] = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                    for i, j in zip(told, top.tolist(), strict=True):
                        best[i] = names[j]
                    if fit:
                        mean = (total - before)[np.arange(len(told)), top] / sizes
                        sizes = sizes.astype(np.float64)
                        for r, i in enumerate(told):
                            if not DIGIT.search(texts[i]):
                                continue
                            words = " ".join(w for w in texts[i].split() if not DIGIT.search(w))
                            if has_letter(words):
                                own, count = log_chances([words], matrix[:, top[r] : top[r] + 1])
                                mean[r], sizes[r] = own[0, 0] / count[0], count[0]
                        fits[told] = (mean - middle[top]) / (width[top] * (1 + ALLOWANCE / np.sqrt(sizes)))
                arrays, added = [pa.array(best, pa.string()), pa.array(chance)], [predicted, score]
                if fit:
                    arrays, added = [*arrays, pa.array(fits, from_pandas=True)], [*added, fit]
                yield append_columns(part, arrays, added)

    fields = [(predicted, T.StringType()), (score, T.DoubleType()), *([(fit, T.DoubleType())] if fit else [])]
    return df.mapInArrow(run, with_fields(df.schema, fields))
