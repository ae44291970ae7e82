"""Every query against SQL or a brute-force version on the small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from compare import connect, difference

from ontime.llm.queries import ORACLE, QUERIES

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) is None


def test_languages_of_held_out_documents(spark, sf_dir, documents):
    rows = QUERIES["op3_language_id"](spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == set(documents)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in documents if remainder(d, 4) == 2}
    assert sum(r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_of_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op7_quality"](spark, "/root/testdata/sf0.01").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(rows[d], q) for d, q in labels.items() if rows[d]["held_out"]]
    assert np.mean([r["predicted"] == q for r, q in held]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())


def test_scores_against_plain_counts(spark, sf_dir, documents):
    tokens = {d: [*WORD.findall((r["text"] or "").translate(LOWER)), "\n"] for d, r in documents.items()}
    counts = Counter()
    for d, words in tokens.items():
        if remainder(d, 10):
            counts.update(words)
    total, types = sum(counts.values()), len(counts)
    rows = QUERIES["op4_interpolation"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for r in rows:
        words = tokens[r["doc_id"]]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in words)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(w in counts for w in words), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["held_out"] == (remainder(r["doc_id"], 10) == 0) and r["score"] < 0
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_nearest_against_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    v, ids = np.array(table["embedding"].tolist(), float), table["vec_id"].to_numpy()
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    found = defaultdict(list)
    for r in sorted(QUERIES["op5_vp_tree"](spark, sf_dir).collect(), key=lambda r: r["rank"]):
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {int(i) for i in ids if i % 50 == 0}
    for q, rows in found.items():
        score = unit @ unit[list(ids).index(q)]
        best = sorted((-round(s, 12), i) for s, i in zip(score, ids, strict=True) if i != q)[:5]
        assert [(k, i) for k, i, _ in rows] == [(k, i) for k, (_, i) in enumerate(best, start=1)]
        assert [s for *_, s in rows] == pytest.approx([-s for s, _ in best], abs=1e-9)


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks):
    """{doc_id: smallest id reachable} from all pairs."""
    least = {d: d for d in marks}

    def top(d):
        while least[d] != d:
            d = least[d]
        return d

    names = sorted(marks)
    for i, a in enumerate(names):
        for b in names[:i]:
            if (marks[a] ^ marks[b]).bit_count() <= 3:
                x, y = sorted((top(a), top(b)))
                least[y] = x
    return {d: top(d) for d in marks}


def test_components_against_all_pairs(spark, sf_dir, documents):
    marks = {d: plain_fingerprint(r["text"]) for d, r in documents.items()}
    wanted = plain_components(marks)
    rows = QUERIES["op9_simhash"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows} == {
        (d, f"{marks[d]:016x}", wanted[d]) for d in documents
    }
