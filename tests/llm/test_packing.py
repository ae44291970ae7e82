import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ontime.llm.packing import Encoder, Plan, combinations, nnls, pack
from ontime.llm.queries import QUERIES, VOCABULARY


def check(pieces, documents, window):
    """Every id in exactly one piece, sequences gapless and full enough."""
    library = Tokenizer.from_file(VOCABULARY)
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    wanted = defaultdict(list)
    for doc_id, text in documents:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        wanted[doc_id, len(ids)].append(ids)
    assert by_doc.keys() == wanted.keys()
    for key, texts in wanted.items():
        found = sorted(by_doc[key], key=lambda p: p["start"])
        assert sum(p["length"] for p in found) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for p in found:
                assert p["start"] == at
                at += p["length"]
                assert p["ids_crc32"] == zlib.crc32(texts[0][p["start"] : at])
    return sum(window - sum(n for _, n in parts) for parts in sequences.values()), len(sequences)


def test_query_packs_everything(spark, sf_dir):
    documents = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    padding, sequences = check(QUERIES["op1_packing"](spark, sf_dir).collect(), documents, 1024)
    assert padding < 0.02 * 1024 * sequences


@pytest.mark.parametrize("window,unit", [(1024, 4), (64, 1), (8, 8)])
def test_odd_rows(odd_documents, no_documents, window, unit):
    documents = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    check(pack(odd_documents, VOCABULARY, window=window, unit=unit).collect(), documents, window)
    assert pack(no_documents, VOCABULARY).count() == 0


def test_combinations_fill_the_window():
    found = combinations(12, 3)
    assert all(sum(c) == 12 and len(c) <= 3 for c in found)
    assert len(set(found)) == len(found) == sum(1 for a in range(13) for b in range(a + 1) for c in range(b + 1) if a + b + c == 12)


def test_least_squares_is_optimal():
    rng = np.random.default_rng(3)
    a, b = rng.random((20, 40)), rng.random(20) * 100
    x = nnls(a, b, 200)
    slope = a.T @ (b - a @ x)
    assert x.min() >= 0 and slope.max() < 1e-3 and np.abs(slope[x > 0]).max(initial=0) < 1e-3


@pytest.mark.parametrize("histogram", [{700: 10**9}, {1: 10**12}, {256: 3}, {k: k * 17 % 1000 for k in range(1, 257)}])
def test_plan_places_every_rank_once(histogram):
    histogram = {min(k, 256): n for k, n in histogram.items()}
    plan = Plan(histogram, 256)
    taken = defaultdict(list)
    for size, first, base, slot, cut, rest, _ in plan.runs:
        taken[size].append(first)
        assert cut < size and rest == (size - cut if cut else 0)
    assert all(plan.given[k] == plan.total[k] for k in plan.total)
    units = sum(k * n for k, n in histogram.items())
    assert plan.sequences == -(-units // 256)
    assert len(plan.runs) < 50_000


@pytest.mark.parametrize("run", [" " * 1_100_000, "\n" * 1_100_000, " \n\t" * 400_000])
def test_runs_that_the_fast_encoder_cannot_split(run):
    text = f"one{run}two  three"
    with open(VOCABULARY, encoding="utf-8") as f:
        ids = Encoder(f.read()).ids(text).tolist()
    assert ids == Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids
