"""Language and quality against plain versions, and the same results however texts are cut."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_queries import remainder

from ontime.llm import language, quality
from ontime.llm.common import lacks_remainder
from ontime.llm.queries import QUERIES


def plain_grams(text):
    out, codes = [], [ord(c) for c in text.lower()]
    for n in language.LENGTHS:
        for i in range(len(codes) - n + 1):
            state = 0
            for c in codes[i : i + n]:
                state = (state * 0x100000001B3 + c) % 2**64
            out.append(((state + n) * 0x9E3779B97F4A7C15 % 2**64 >> 40) % language.BUCKETS)
    return out


def test_language_against_plain_bayes(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    grams = {r["doc_id"]: Counter(plain_grams(r["text"] or "")) for r in rows}
    counts, documents = defaultdict(Counter), Counter()
    for r in rows:
        if r["lang"] is not None and remainder(r["doc_id"], 4) != 2:
            counts[r["lang"]].update(grams[r["doc_id"]])
            documents[r["lang"]] += 1
    total = {k: sum(c.values()) + language.SMOOTHING * language.BUCKETS for k, c in counts.items()}
    found = {r["doc_id"]: r for r in QUERIES["op3_language_id"](spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for r in rows:
        got = found[r["doc_id"]]
        assert got["held_out"] == (remainder(r["doc_id"], 4) == 2)
        if not any(map(str.isalpha, r["text"] or "")):
            assert (got["lang_pred"], got["score"]) == ("und", 0)
            continue
        logs = {
            k: math.log(documents[k] / documents.total())
            + sum(n * math.log((counts[k][g] + language.SMOOTHING) / total[k]) for g, n in grams[r["doc_id"]].items())
            for k in counts
        }
        best = max(sorted(logs), key=logs.get)
        assert got["lang_pred"] == best
        assert got["score"] == pytest.approx(1 / sum(math.exp(x - logs[best]) for x in logs.values()), abs=1e-3 if got["score"] < 0.999 else 1e-6)



def plain_tokens(text):
    """Words (letters, digits, all that is not ASCII) and runs of marks, by their kinds of bytes."""
    kind = lambda b: quality.KINDS[b]
    out, data = [], text.encode()
    for i, b in enumerate(data):
        if kind(b) != quality.SPACE:
            if i and kind(data[i - 1]) == kind(b):
                out[-1] += bytes([b])
            else:
                out.append(bytes([b]))
    return out


def test_quality_against_plain_pass(spark, sf_dir):
    """Word vectors recounted word by word, and the network's pass written out."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(lacks_remainder("doc_id", 4, 2))
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    bucket = {}
    for t in texts.values():
        new = [w for w in plain_tokens(t) if w not in bucket]
        if new:
            own = quality.tokens([" ".join(["x", *[w.decode() for w in new]])])[0]
            if len(own) == len(new) + 1:
                bucket.update(zip(new, own[1:].tolist(), strict=True))
    places, signs = quality.index_vectors()
    table = np.zeros((quality.BUCKETS, quality.DIMENSIONS))
    words = {d: [bucket[w] for w in plain_tokens(t)] for d, t in texts.items()}
    for own in words.values():
        for i, w in enumerate(own):
            for j in range(max(0, i - quality.REACH), min(len(own), i + quality.REACH + 1)):
                if j != i:
                    np.add.at(table[w], places[own[j]], signs[own[j]])
    unit = table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-12)
    vectors = quality.word_vectors(documents, "text")
    assert np.allclose(vectors, unit, atol=1e-6)
    model = quality.fit(documents, labels, vectors, "doc_id", "text", "quality", quality.SAMPLE)
    scored = quality.score_quality(documents, labels, F.lit(True))
    a, b, c, d = model.weights
    for r in scored.collect():
        own = unit[words[r["doc_id"]]] if words[r["doc_id"]] else np.zeros((1, quality.DIMENSIONS))
        x = [*own.mean(axis=0), *own.std(axis=0), math.log1p(len(words[r["doc_id"]]))]
        hidden = np.tanh((np.array(x) - model.shift) / model.scale @ a + b)
        logit = float((hidden @ c)) + float(d[0]) + model.base
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-logit / model.temperature)), abs=2e-3)


def test_cutting_changes_nothing(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choices("abc éİΣ1.,\n", k=rng.randrange(0, 70))) for _ in range(50)] + ["", "x" * 50]
    matrix, vectors = rng_matrix(language.BUCKETS, 3), rng_matrix(quality.BUCKETS, quality.DIMENSIONS).astype(np.float32)
    whole = [*language.log_chances(texts, matrix), *quality.tokens(texts), quality.pool(texts, vectors)]
    monkeypatch.setattr(language, "BLOCK", 7)
    monkeypatch.setattr(quality, "BLOCK", 5)
    monkeypatch.setattr(quality, "POOLED", 3)
    cut = [*language.log_chances(texts, matrix), *quality.tokens(texts), quality.pool(texts, vectors)]
    for x, y in zip(whole, cut, strict=True):
        assert np.allclose(x, y, atol=1e-6)


def rng_matrix(*shape):
    return np.random.default_rng(5).random(shape)
