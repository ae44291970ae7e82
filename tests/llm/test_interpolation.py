"""Scores against plain counting and expectation-maximisation over single tokens."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_queries import LOWER, WORD

from ontime.llm.interpolation import ROUNDS, bucket, grid_for, score_texts


def plain_scores(texts, learned):
    """Bigram mixture per text; EM runs on every learned token, not on cells."""
    tokens = [["<s>", *WORD.findall((t or "").translate(LOWER)), "\n"] for t in texts]
    words, pairs, heads = Counter(), Counter(), sum(learned)
    for t, use in zip(tokens, learned, strict=True):
        if use:
            words.update(t[1:])
            pairs.update(zip(t, t[1:], strict=False))
    total, uniform = sum(words.values()), 1 / (len(words) + 1)
    level = lambda c: c.bit_length()
    events = {}
    for t, use in zip(tokens, learned, strict=True):
        own, own_pairs = Counter(t), Counter(zip(t, t[1:], strict=False))
        for u, w in zip(t, t[1:], strict=False) if use else ():
            c1 = (heads if u == "<s>" else words[u]) - own[u]
            unigram = (words[w] - own[w]) / max(total - len(t) + 1, 1)
            bigram = (pairs[u, w] - own_pairs[u, w]) / c1 if c1 else 0.0
            events.setdefault(level(c1), []).append((uniform, unigram, bigram))
    weights = {}
    for b in range(64):
        start = np.array([1, 1, 1.0 if b else 0.0])
        if b not in events:
            weights[b] = weights[b - 1] if b > 1 else start / start.sum()
            continue
        p, w = np.array(events[b]), start / start.sum()
        for _ in range(ROUNDS):
            share = p * w
            w = (share / share.sum(axis=1, keepdims=True)).mean(axis=0)
        w = np.maximum(w, 1e-6 * start)
        weights[b] = w / w.sum()
    out = []
    for t in tokens:
        score = 0.0
        for u, w in zip(t, t[1:], strict=False):
            c1 = heads if u == "<s>" else words[u]
            mix = weights[level(c1)]
            score += math.log10(mix[0] * uniform + mix[1] * words[w] / max(total, 1) + mix[2] * pairs[u, w] / max(c1, 1))
        out.append(score)
    return out


def test_scores_against_plain_mixture(spark, sf_dir):
    """The cells of EM are half powers of two wide: scores differ by less than a hundredth."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    learned = [zlib.crc32(str(r.doc_id).encode()) % 10 != 0 for r in rows]
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    got = {r.doc_id: r.score for r in score_texts(spark.createDataFrame(rows), learn).collect()}
    want = plain_scores([r.text for r in rows], learned)
    assert len(got) == len(rows)
    for r, score in zip(rows, want, strict=True):
        assert got[r.doc_id] == pytest.approx(score, rel=0.01)
    assert sum(got.values()) == pytest.approx(sum(want), rel=0.002)


def test_cells_have_room_for_any_count():
    for total in (0, 1, 2, 1000, 2**24, 10**13):
        grid = grid_for(total)
        counts = np.array([0, 1, max(total, 1)])
        assert bucket(counts).max() < grid.buckets and bucket(counts)[0] == 0
        cells = grid.cell(np.array([0.0, 1 / max(total, 1), 1.0]))
        assert cells[0] == 0 < cells[1] <= cells[2] == grid.side - 1
        assert total < 2 or cells[2] - cells[1] == int(2 * math.log2(total))


def test_nothing_is_left_in_the_catalog(spark):
    before = {d.name for d in spark.catalog.listDatabases()}
    texts = spark.createDataFrame([(1, "a b a"), (2, None)], "doc_id long, text string")
    assert score_texts(texts, F.lit(True)).count() == 2
    with pytest.raises(Exception, match="broken"):
        score_texts(texts, F.raise_error(F.lit("broken")).cast("boolean"))
    assert {d.name for d in spark.catalog.listDatabases()} == before
