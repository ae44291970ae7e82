"""Periodic runs against a plain search, on short words, whole documents and odd rows."""

import random
import re
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from ontime.llm.periodic import SuffixTree, find_runs, lyndon_lengths, runs_of
from ontime.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(s, least=12):
    """All maximal stretches per period; of equal stretches the smallest period stays."""
    found = {}
    for p in range(1, len(s) // 2 + 1):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            size = j - i + p
            if size >= max(least, 2 * p):
                inside = [(a, b) for a, b in found if a <= i and i + size <= b and p % found[a, b] == 0]
                if not inside:
                    found[i, i + size] = p
            i = j + 1
    return sorted((a, b - a, p) for (a, b), p in found.items())


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for at, size, p in runs for i in range(at + p, at + size)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
        sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def test_short_words_against_plain_search():
    rng = random.Random(1)
    for _ in range(1500):
        s = [rng.randint(1, rng.choice([2, 3, 4])) for _ in range(rng.randrange(2, 45))]
        least = rng.choice([2, 4, 12])
        assert runs_of(s, least) == plain_runs(s, least), s


def test_tree_answers():
    rng = random.Random(2)
    for _ in range(100):
        s = [rng.randint(1, 3) for _ in range(rng.randrange(1, 40))]
        tree, n = SuffixTree(s, ranks=True), len(s)
        order = sorted(range(n + 1), key=lambda i: s[i:])
        assert sorted(range(n + 1), key=lambda i: tree.rank[i]) == order
        assert sorted(range(n + 1), key=lambda i: tree.opposite[i]) == sorted(range(n + 1), key=lambda i: [-c for c in s[i:]])
        lengths = lyndon_lengths(tree.rank)
        for i in range(n):
            lyndon = [j for j in range(i + 1, n + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j))]
            assert lengths[i] == max(lyndon) - i


def test_query_against_plain_search(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in documents if len(r["text"] or "") < 6000]
    found = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    assert len(found) == len(documents) and len(short) > 0.7 * len(documents)
    assert sum(r[1] > 0 for r in found.values()) > 0.05 * len(documents)
    for r in short:
        assert found[r["doc_id"]] == plain_row(r["doc_id"], r["text"])


def test_odd_rows(spark, odd_documents, no_documents):
    got = find_runs(odd_documents).collect()
    assert len(got) == odd_documents.count()
    for r in got:
        words = WORD.findall(r["text"] or "")
        if len(words) < 1000:
            assert sorted((x["start"], x["length"], x["period"]) for x in r["runs"]) == plain_runs(words)
        if not r["runs"]:
            assert r["collapsed"] == " ".join(words)
    long = next(r for r in got if (r["text"] or "").startswith("the of and the"))
    assert [tuple(x) for x in long["runs"]] == [(0, 12000, 3)] and long["collapsed"] == "the of and"
    assert find_runs(no_documents).count() == 0
    with pytest.raises(ValueError, match="runs"):
        find_runs(odd_documents.withColumn("Runs", F.lit(1)))


def test_stretches_of_several_documents(spark):
    """Periods that meet at a document's edge, runs that overlap, one word for ever."""
    rng = random.Random(3)
    texts = []
    for _ in range(150):
        words = [str(rng.randrange(rng.choice([1, 2, 40]))) for _ in range(rng.randrange(0, 50))]
        unit = [str(rng.randrange(30)) for _ in range(rng.randrange(1, 9))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (unit * 20)[: rng.randrange(0, 50)]
        texts.append(rng.choice([" ", "\n", " \t "]).join(words))
    texts += ["a " * 50, "a " * 50, "b c " * 7, "x y " * 13, "é " * 30000]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for r in find_runs(table).collect():
        words = WORD.findall(r["text"])
        runs = sorted((x["start"], x["length"], x["period"]) for x in r["runs"])
        assert runs == ([(0, 30000, 1)] if len(words) == 30000 else plain_runs(words))
