"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import random
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_queries import plain_components, plain_fingerprint

import corpus_pipeline
from ontime.llm.common import lacks_remainder
from ontime.llm.exact_dedup import drop_exact_copies, exact_groups
from ontime.llm.interpolation import score_texts
from ontime.llm.language import identify_language
from ontime.llm.line_dedup import drop_boilerplate
from ontime.llm.quality import score_quality
from ontime.llm.queries import listed_urls
from ontime.llm.simhash import components, drop_near_copies, near_links, simhash_components, spanning_links
from ontime.llm.url_filter import bloom_filter, blocks_for, canonical, judge_urls, masks
from ontime.llm.vptree import nearest


def test_language(odd_documents, no_documents):
    rows = identify_language(odd_documents, F.lit(True)).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        if not any(map(str.isalpha, r["text"] or "")):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "fr")
    assert identify_language(no_documents, F.lit(True)).count() == 0
    untaught = identify_language(odd_documents, F.lit(False)).select("lang_pred").distinct().collect()
    assert [r[0] for r in untaught] == ["und"]
    with pytest.raises(ValueError, match="tokens"):
        identify_language(odd_documents, F.lit(True), score="tokens")


def test_quality(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, None), (7, 1), (7, 0), (None, 1), (12, 0), (13, 1), (3, 0)], "doc_id long, quality int")
    rows = score_quality(odd_documents, labels, F.lit(True)).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert score_quality(no_documents, labels, F.lit(True)).count() == 0
    constant = score_quality(odd_documents, labels.filter("quality = 1"), F.lit(True)).select("score").distinct().collect()
    assert len(constant) == 1 and constant[0][0] > 0.5
    assert score_quality(odd_documents, labels.limit(0), F.lit(True)).first()["score"] == 0.5


def test_exact_groups(odd_documents, no_documents):
    rows = exact_groups(odd_documents).collect()
    texts = {}
    for r in odd_documents.collect():
        texts.setdefault(" ".join(("x" + (r["text"] or "") + "x").split())[1:-1], []).append(r["doc_id"])
    assert sorted(r["group_size"] for r in rows) == sorted(len(v) for v in texts.values() for _ in v)
    assert sum(r["kept"] for r in rows) == len({r["text_sha256"] for r in rows}) == len(texts)
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])
    assert exact_groups(no_documents).count() == 0
    kept = drop_exact_copies(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() == len(texts)
    assert drop_exact_copies(no_documents).count() == 0


def test_simhash(odd_documents, no_documents):
    rows = simhash_components(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    empty = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert len(empty) == 5 and {r["component_id"] for r in empty} == {0}
    kept = drop_near_copies(odd_documents)
    assert kept.columns == odd_documents.columns
    roots = len({r["component_id"] for r in rows})
    assert kept.count() == roots
    assert simhash_components(no_documents).count() == 0 and drop_near_copies(no_documents).count() == 0


@pytest.mark.parametrize("slice_size", [8, 2000])
def test_dense_blocks_lose_no_link(spark, slice_size):
    """Many fingerprints around a few centres, in slices and whole."""
    rng = random.Random(5)
    marks = set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        marks |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(60)}
    marks |= {rng.getrandbits(64) for _ in range(40)}
    names = dict(enumerate(sorted(marks)))
    wanted = plain_components(names)
    signed = {i: m - (1 << 64) if m >> 63 else m for i, m in names.items()}
    table = spark.createDataFrame([(m,) for m in signed.values()], "fp long")
    root = {r["node"]: r["root"] for r in components(near_links(table, slice_size=slice_size)).collect()}
    found, given = {}, {}
    for i, m in signed.items():
        found.setdefault(root.get(m, m), set()).add(i)
        given.setdefault(wanted[i], set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, given.values()))
    values = np.array(list(marks), np.uint64)
    assert len(spanning_links(values, values[:0], 3)) < len(values)


def test_long_chains_are_one_component(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    rows = components(chain).collect()
    assert {r["node"] for r in rows} == set(range(301)) and {r["root"] for r in rows} == {0}


def test_scores(odd_documents, no_documents):
    rows = score_texts(odd_documents, lacks_remainder("doc_id", 10, 0)).collect()
    assert len(rows) == odd_documents.count()
    assert all(np.isfinite(r["score"]) and r["score"] <= 0 and r["n_tokens"] >= 1 for r in rows)
    assert score_texts(no_documents, F.lit(True)).count() == 0
    untaught = score_texts(odd_documents, F.lit(False)).collect()
    assert {r["train_tokens"] for r in untaught} == {0} and {r["n_known"] for r in untaught} == {0}


def test_nearest(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (50, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [2.0, 0.0]), (9, [-1.0, 0.0]), (7, [0.0, 1.0]), (7, [0.0, 1.0]),
        (100, [0.0, 0.0]), (150, None), (200, [nan, 1.0]), (250, [inf, 1.0]), (300, [None, 1.0]), (None, [1.0, 0.0]), (350, [1.0, 2.0, 3.0]), (0, [1.0, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).withColumn("score", F.lit(2))
    found = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in nearest(table).collect())
    near = [(1, 2), (2, 3), (3, 50), (4, 7), (5, 7)]
    assert [f[1:] for f in found if f[0] == 0] == sorted([*near, *near])
    assert [f[1:] for f in found if f[0] == 50] == [(1, 0), (2, 0), (3, 2), (4, 3), (5, 7)]
    assert {f[0] for f in found} == {0, 50}
    assert nearest(table.filter("vec_id = -1")).count() == 0
    small = nearest(table, shard_rows=2, block_rows=1).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in small) == found


def test_nearest_keeps_all_ties(spark):
    """Scaled copies, sign vectors and signed one-hots tie by the dozen; the last
    cannot be split evenly. An id repeated with one vector hides no other id."""
    rng = np.random.default_rng(3)
    signs = rng.choice([-1.0, 1.0], (400, 8)) * 2.0 ** rng.integers(-3, 4, (400, 1))
    hots = np.concatenate([np.eye(300), -np.eye(300)])
    tables = [
        [(i, [2.0 ** (i % 40), 0.0]) for i in range(40)][::-1],
        [(int(i), v.tolist()) for i, v in zip(rng.permutation(400), signs, strict=True)],
        [(0, [1.0, 0.0])] * 12 + [(i, [1.0, 0.0]) for i in range(1, 9)],
        [(0, [1.0, float(i)]) for i in range(12)] + [(i, [-1.0, -float(i)]) for i in range(1, 9)],
        [(i, v.tolist()) for i, v in enumerate(hots)],
    ]
    for rows in tables:
        table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        ids, v = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
        score = np.round(v @ v.T / np.outer(np.linalg.norm(v, axis=1), np.linalg.norm(v, axis=1)), 12)
        wanted = []
        for q in np.flatnonzero(ids % 50 == 0):
            best = np.lexsort((ids, -score[q]))
            best = best[ids[best] != ids[q]][:5]
            wanted += [(int(ids[q]), rank, int(ids[b])) for rank, b in enumerate(best, start=1)]
        found = [(r["query_id"], r["rank"], r["vec_id"]) for r in nearest(table).collect()]
        assert sorted(found) == sorted(wanted)


def test_blocks_of_queries_are_not_broadcast(spark):
    """A block is there once per shard, which the optimizer's estimate leaves out."""
    rows = [(i, [float(i % 7), float(i % 11) + 1]) for i in range(200)]
    found = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), shard_rows=10, block_rows=2)
    assert found.count() == 20
    assert "BroadcastExchange" not in found._jdf.queryExecution().toString()


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Net", "http://a.net/x", "x://EXAMPLE.net/en/1", "x://a.example.net/de/", "http://www.bad.com/p/?utm_x=1&b=2&a=1#f", "https://bad.com/p?a=1&b=2", "http://good.com/p", "http://notexample.com/de/", "http://example.com?/de/", "http://f.org/fr/a"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)] + [(8, urls[8], 1)], "page_id long, url string, block int")
    listed = spark.createDataFrame([("http://bad.com/p?b=2&a=1",), (None,), ("junk",)], "url string")
    for blocks in (1, 1 << 17):
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, listed, blocks=blocks).collect()}
        assert got[0] == got[1] == got[2] == ("", "", None, "allow") and got[3] == ("", "", None, "allow")
        assert got[4] == ("a.net", "", None, "allow") and got[5] == ("a.net", "/x", "net/", "block")
        assert got[6] == ("example.net", "/en/1", "example.net/en/", "allow") and got[7][2:] == ("net/", "block")
        assert got[8][3] == got[9][3] == "block" and got[10][3] == "allow"
        assert got[11][2] is None and got[12] == ("example.com", "", None, "allow") and got[13][2:] == ("org/fr/", "allow")
    assert judge_urls(pages, listed).count() == len(urls) + 1
    assert judge_urls(pages, listed.limit(0)).filter("verdict = 'block' and rule is null").count() == 0
    assert judge_urls(pages.limit(0), listed).count() == 0
    with pytest.raises(ValueError, match="host"):
        judge_urls(pages.withColumn("Host", F.lit(1)), listed)


def test_false_hits_of_the_url_filter_go_in_the_join(spark):
    """One block of 256 bits for a thousand URLs: every URL is a possible hit."""
    listed = spark.range(1000).select(F.concat(F.lit("http://a.com/"), "id").alias("url"))
    pages = spark.range(500, 3000).select(F.col("id").alias("page_id"), F.concat(F.lit("https://www.a.com/"), "id", F.lit("/?utm_source=x")).alias("url"))
    hits = pages.crossJoin(bloom_filter(listed.select(canonical(F.col("url")).alias("key")), "key", 1))
    bits = [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(masks(canonical(F.col("url"))))]
    assert hits.filter(reduce(lambda a, b: a & b, bits)).count() == 2500
    for blocks in (1, None):
        got = judge_urls(pages, listed, blocks=blocks).groupBy("verdict").agg(F.count("*"), F.min("page_id"), F.max("page_id"))
        assert {tuple(r) for r in got.collect()} == {("block", 500, 500, 999), ("allow", 2000, 1000, 2999)}
    assert [blocks_for(n) for n in (0, 16 << 10, (16 << 10) + 1, 1 << 40)] == [1 << 10, 1 << 10, 1 << 11, 1 << 19]


def test_listed_urls(spark):
    """Spam sites by host, toxic documents by the number in the path; odd labels and paths list nothing."""
    urls = ["http://a.com/en/5", "http://b.org/fr/5.html?x=1", "http://a.com/en/6", "http://www.spam-farm.x.com/en/6", "http://a.com/5", None, "", "http://a.com/en/99999999999999999999"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(5, 1), (5, 1), (6, 0), (6, None), (None, 1)], "doc_id long, toxic int")
    assert sorted(r.url for r in listed_urls(pages, labels).collect()) == sorted([urls[0], urls[1], urls[3]])
    assert listed_urls(pages, labels.limit(0)).count() == 1 and listed_urls(pages.limit(0), labels).count() == 0


def test_lines(spark):
    html = ["<nav>menu</nav><p>one</p>", "<nav>menu</nav><p>two\ntwo</p>", "<p>menu</p><script>menu()</script>", "menu<!-- menu -->", None, ""]
    pages = spark.createDataFrame([(i, "http://h.com/x", h, 0) for i, h in enumerate(html)] + [(9, None, "menu", 0)], "page_id long, url string, html string, lines int")
    got = {r["page_id"]: (r["n_lines"], r["n_kept"], r["text"]) for r in drop_boilerplate(pages).collect()}
    assert got[0] == (2, 1, "one") and got[1] == (3, 2, "two\ntwo") and got[2] == (1, 0, "") and got[4] == got[5] == (0, 0, "")
    assert got[9] == (1, 1, "menu")
    assert drop_boilerplate(pages.limit(0)).count() == 0
    with pytest.raises(ValueError, match="text"):
        drop_boilerplate(pages.withColumn("Text", F.lit(1)))


def test_lines_of_small_hosts_and_crlf(spark):
    """Two pages of two with a line are boilerplate, one page of one is not; a carriage return is no part of a line."""
    rows = [(0, "http://two.com/a", "menu\r\n\tone\r\n\r\n"), (1, "http://two.com/b", "<b>menu</b>\n two"), (2, "http://one.com/", "menu"), (2, "http://two.com/c", "menu")]
    rows += [(10 + i, "http://ten.com/", f"line {i}\n" * 2000 + ("half" if i < 2 else "")) for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"], r["host"], r["n_lines"], r["text"][:10]) for r in drop_boilerplate(pages).collect() if r["page_id"] < 10)
    assert got == [(0, "two.com", 2, "one"), (1, "two.com", 2, "two"), (2, "one.com", 1, "menu"), (2, "two.com", 1, "")]
    kept = {r["page_id"]: r["n_kept"] for r in drop_boilerplate(pages).collect() if r["page_id"] >= 10}
    assert kept == {10 + i: 2001 if i < 2 else 2000 for i in range(20)}  # two pages of twenty are not more than a tenth


def test_pipeline_stages_by_hand(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert stages["language_id"](spark, docs, sf_dir).count() == docs.filter("text rlike '\\\\p{L}'").count()
    kept = stages["exact_dedup"](spark, docs, sf_dir)
    texts = {}
    for r in docs.collect():
        key = " ".join(("x" + (r["text"] or "") + "x").split())
        texts[key] = min(texts.get(key, r["doc_id"]), r["doc_id"])
    assert {r["doc_id"] for r in kept.collect()} == set(texts.values()) and kept.schema == docs.schema
    near = stages["simhash_near_dedup"](spark, docs, sf_dir)
    marks = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
    assert {r["doc_id"] for r in near.collect()} == set(plain_components(marks).values()) and near.schema == docs.schema
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.select("doc_id").distinct().count() > 0.5 * len(texts)


def test_language_stage_rejects_foreign_text(spark):
    """Random letters, code and languages never learned go; learned ones stay, with numbers too."""
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(1)
    noise = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9))) for _ in range(60))
    code = "for (int i = 0; i < n; i++) { if (buf[i] == NULL) return -EINVAL; memcpy(&dst[i], src + i, sizeof(*src)); }"
    russian = "Все люди рождаются свободными и равными в своем достоинстве и правах."
    french = "Tous les êtres humains naissent libres et égaux en dignité et en droits."
    added = [(-2, noise), (-3, code * 5), (-4, russian), (-5, french), (-6, french + " 4734663219866878" * 20)]
    table = docs.unionByName(spark.createDataFrame([(i, t, None) for i, t in added], docs.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, table, sf_dir).select("doc_id").collect()}
    assert {i for i, _ in added} & kept == {-5, -6}
    worded = docs.filter("text rlike '\\\\p{L}'").count()
    assert 0.999 * worded <= len([i for i in kept if i >= 0]) <= worded


def test_pipeline_takes_odd_rows(spark, sf_dir, odd_documents):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd_documents, sf_dir)
        assert out.columns == odd_documents.columns
        assert 0 <= out.count() <= odd_documents.count()
    assert corpus_pipeline.STAGES[-1][1](spark, odd_documents, sf_dir).count() > 0
