"""The operators as queries over the given tables, with SQL where it can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm.bpe import decode_documents, encode_documents
from ontime.llm.common import has_remainder, lacks_remainder, read_table
from ontime.llm.exact_dedup import exact_groups
from ontime.llm.interpolation import score_texts
from ontime.llm.language import identify_language
from ontime.llm.line_dedup import drop_boilerplate
from ontime.llm.merkle import fold, leaf_digest, manifest, proof
from ontime.llm.merkle_sql import MERKLE_SQL, UPPER
from ontime.llm.packing import pack
from ontime.llm.periodic import find_runs
from ontime.llm.quality import THRESHOLD, score_quality
from ontime.llm.simhash import simhash_components
from ontime.llm.suffix_dedup import drop_repeats
from ontime.llm.url_filter import host_of, judge_urls, path_of
from ontime.llm.vptree import nearest

# Fixed value: sites all of whose URLs are on the list of the URL filter.
SPAM_SITE = r"(^|\.)(spam-farm|cheap-pills)\."
# The document a page shows, by the paths of the pages: /language/doc_id.
PAGE_DOCUMENT = r"^/[^/]*/([0-9]+)"

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), VOCABULARY)


def listed_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The list: the URLs of sites that are known for spam, and those under which a
    document labelled toxic was met, whatever the site."""
    spam = pages.filter(host_of(F.col("url")).rlike(SPAM_SITE)).select("url")
    shown = pages.select("url", F.regexp_extract(path_of(F.col("url")), PAGE_DOCUMENT, 1).try_cast("bigint").alias("doc_id"))
    toxic = labels.filter("toxic = 1").select("doc_id")
    return spam.unionByName(shown.join(toxic, "doc_id", "left_semi").select("url"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, listed_urls(pages, read_table(spark, sf_dir, "labels"))).drop("url")


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = identify_language(documents, lacks_remainder("doc_id", 4, 2))
    return out.select("doc_id", has_remainder("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_texts(documents, lacks_remainder("doc_id", 10, 0))
    names = [c for c in out.columns if c not in ("doc_id", "text")]
    return out.select("doc_id", has_remainder("doc_id", 10, 0).alias("held_out"), *names)


def vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_quality(documents, read_table(spark, sf_dir, "labels"), lacks_remainder("doc_id", 4, 2))
    return out.select(
        "doc_id",
        has_remainder("doc_id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return drop_boilerplate(pages).select("page_id", "host", "n_lines", "n_kept", "text")


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY)
    decoded = decode_documents(encoded.drop("text"), VOCABULARY)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["to"] - s["from"])
    return found.select(
        "doc_id",
        (F.octet_length("kept") + removed).alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth document, by the checksum of its id, is tampered with."""
    documents = read_table(spark, sf_dir, "documents")
    fields = {f: F.col(f) for f in ("doc_id", "source", "lang", "n_chars", "text")}
    lowered = {**fields, "text": F.translate("text", UPPER, UPPER.lower())}
    leaves = documents.select(
        "doc_id",
        "source",
        leaf_digest(list(fields.values())).alias("leaf"),
        F.when(has_remainder("doc_id", 5, 0), leaf_digest(list(lowered.values()))).alias("tampered"),
    )
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return (
        manifest(leaves)
        .withColumn("folded_root", folded)
        .select(
            "doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """Every tenth document, by the checksum of its id, repeats a stretch from a word
    of its own choice to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    split = documents.withColumns({"h": h, "words": F.when(h % 10 == 0, words)})
    split = split.withColumns({"n": F.size("words").cast("long"), "g": F.floor(F.col("h") / 10)})
    changed = split.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    changed = changed.withColumn("rest", (F.col("n") - F.col("a")).cast("int"))
    changed = changed.withColumn("p", (F.floor(F.col("rest") / (F.col("g") % 8 + 3)) + 1).cast("int"))
    unit = F.slice("words", F.col("a") + 1, F.col("p"))
    again = F.flatten(F.array_repeat(unit, F.ceil(F.col("rest") / F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), F.col("rest"))), " ")
    return changed.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(with_planted_runs(documents))
    # The longest run, of those the first, of those the one of the smallest period.
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    found = found.withColumn("longest", F.array_max(order))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_packing": packing,
    "op2_url_filter": url_filter,
    "op3_language_id": language,
    "op4_interpolation": interpolation,
    "op5_vp_tree": vantage_points,
    "op6_line_dedup": line_dedup,
    "op7_quality": quality,
    "op8_bpe": bpe,
    "op9_simhash": simhash,
    "op10_exact_dedup": exact_dedup,
    "op11_suffix_dedup": suffix_dedup,
    "op12_merkle": merkle,
    "op13_periodic_runs": periodic,
}

# Equal texts, the smallest id of each group, and the digest of the normalised text.
ORACLE: dict[str, str] = {
    "op2_url_filter": r"""
WITH u AS (
 SELECT page_id,
  translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 3), '') AS query
 FROM pages),
q AS (
 SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'),
  lambda p: p <> '' AND NOT starts_with(p, 'utm_'))), '&') AS kept FROM u),
c AS (
 SELECT page_id, host, path, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
  || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END AS canonical FROM q),
l AS (
 SELECT DISTINCT canonical FROM c WHERE canonical <> '' AND (regexp_matches(host, '(^|\.)(spam-farm|cheap-pills)\.')
  OR TRY_CAST(regexp_extract(path, '^/[^/]*/([0-9]+)', 1) AS BIGINT) IN (SELECT doc_id FROM labels WHERE toxic = 1))),
r AS (
 SELECT c.*, l.canonical IS NOT NULL AS listed,
  CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
   WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
   WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
   WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
 FROM c LEFT JOIN l USING (canonical))
SELECT page_id, host, path, rule,
 CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM r""",
    "op6_line_dedup": r"""
WITH p AS (
 SELECT row_number() OVER () AS k, page_id,
  translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  list_filter(list_transform(string_split(regexp_replace(regexp_replace(coalesce(html, ''),
   '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', chr(10), 'g'),
   '(?s)<[^>]*>', chr(10), 'g'), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '') AS lines
 FROM pages),
t AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
x AS (SELECT host, k, unnest(list_distinct(lines)) AS line FROM p),
n AS (SELECT host, line, count(*) AS n FROM x GROUP BY host, line),
b AS (SELECT host, list(line) AS common FROM n JOIN t USING (host) WHERE n >= 2 AND n > pages * 0.1 GROUP BY host),
j AS (
 SELECT p.*, list_filter(lines, lambda x: NOT list_contains(coalesce(common, []), x)) AS kept
 FROM p LEFT JOIN b USING (host))
SELECT page_id, host, len(lines) AS n_lines, len(kept) AS n_kept, array_to_string(kept, chr(10)) AS text FROM j""",
    "op10_exact_dedup": r"""
WITH d AS (
 SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
 FROM documents),
r AS (
 SELECT *, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept
 FROM d WINDOW g AS (PARTITION BY text_sha256))
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM r""",
    "op12_merkle": MERKLE_SQL,
}
