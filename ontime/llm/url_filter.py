"""URL filters: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

Each listed URL sets one bit in each of the eight words of one block. A page's URL
is looked up in its block first; only possible hits go to the exact hash join with
the list, which removes the false ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import free_name, materialise

# The filter has a block of 8 words of 32 bits for every KEYS listed URLs (16 bits a
# URL, a false hit in some hundreds), a power of two. It is broadcast, hence the upper
# bound: 2^19 rows, some 100 MB. A list above 8 million URLs passes more false hits to
# the exact join.
KEYS = 16
LEAST_BLOCKS = 1 << 10
MOST_BLOCKS = 1 << 19
WORDS = 8

# Rules as (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def url_part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, group), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(url_part(url, 1), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return url_part(url, 2)


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without a slash at its end, and the query's
    parameters but for campaign tags, in order. Empty for what is no URL."""
    query = F.filter(F.split(url_part(url, 3), "&"), lambda p: (p != "") & ~p.startswith("utm_"))
    query = F.array_join(F.array_sort(query), "&")
    site = F.regexp_replace(host_of(url), r"^www\.", "")
    return F.concat(site, F.regexp_replace(path_of(url), "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def rule_struct(host: Column, path: Column, rules) -> Column:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    out = F
    for site, start, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(start)
        out = out.when(fits, F.struct(F.lit(site + start).alias("rule"), F.lit(verdict).alias("verdict")))
    return out.otherwise(F.lit(None)) if rules else F.lit(None).cast("struct<rule:string,verdict:string>")


def masks(key: Column) -> list[Column]:
    """One bit in each word of the block, from five bits of the hash each."""
    bits = F.xxhash64(key, F.lit("bits"))
    powers = F.array(*[F.lit(1 << i) for i in range(32)])
    places = [F.shiftrightunsigned(bits, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(WORDS)]
    return [F.get(powers, p).cast("long") for p in places]


def block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks))


def blocks_for(n_listed: int) -> int:
    """Blocks of the filter for a list of that many URLs."""
    wanted = 1 << max(0, -(-n_listed // KEYS) - 1).bit_length()
    return min(max(wanted, LEAST_BLOCKS), MOST_BLOCKS)


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0..w7), one row per block in use. Partial blocks are combined
    before the shuffle, so a task sends as many rows as there are blocks at most."""
    bits = listed.select(block(F.col(key), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks(F.col(key)))])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def judge_urls(
    pages: DataFrame, listed: DataFrame, url: str = "url", listed_url: str = "url", rules=RULES, blocks: int | None = None
) -> DataFrame:
    """The rows of ``pages`` with host, path, rule, verdict and listed.

    The longest rule that fits decides; where none does, a URL whose canonical
    form is that of a listed one is blocked and any other allowed. A null URL or
    one without ``://`` has an empty host and path, fits no rule and is never
    listed. Repeated rows stay repeated; an empty list blocks nothing. Columns of
    ``pages`` called like a new one make an error. The filter is sized by the length
    of the list unless ``blocks`` are given; the result is the same with any size.
    """
    clash = {"host", "path", "rule", "verdict", "listed"} & {c.lower() for c in pages.columns}
    if clash:
        raise ValueError(f"there are columns {sorted(clash)} already")
    key, mark, found = (free_name(pages, n) for n in ("canonical", "possible", "fits"))
    keys = listed.select(canonical(F.col(listed_url)).alias(key)).filter(F.col(key) != "").distinct()
    keys = materialise(keys, "listed")
    blocks = blocks or blocks_for(keys.count())
    filters = materialise(bloom_filter(keys, key, blocks), "bloom")

    judged = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url)), key: canonical(F.col(url))})
    at = free_name(pages, "block")
    side = F.broadcast(filters.select(F.col("block").alias(at), *[F.col(f"w{i}").alias(f"{at}{i}") for i in range(WORDS)]))
    looked = judged.withColumn(at, block(F.col(key), blocks)).join(side, at, "left")
    hits = [F.col(f"{at}{i}").bitwiseAND(m) == m for i, m in enumerate(masks(F.col(key)))]
    looked = looked.withColumn(mark, F.coalesce(reduce(lambda a, b: a & b, hits), F.lit(False)))
    looked = looked.drop(at, *[f"{at}{i}" for i in range(WORDS)])

    passed = looked.filter(~F.col(mark)).withColumn("listed", F.lit(False))
    hit = looked.filter(F.col(mark)).join(keys.withColumn("listed", F.lit(True)), key, "left")
    both = passed.unionByName(hit.withColumn("listed", F.coalesce("listed", F.lit(False))))
    both = both.withColumn(found, rule_struct(F.col("host"), F.col("path"), rules))
    default = F.when(F.col("listed"), "block").otherwise("allow")
    return both.select(
        *pages.columns,
        "host",
        "path",
        F.col(f"{found}.rule").alias("rule"),
        F.coalesce(F.col(f"{found}.verdict"), default).alias("verdict"),
        "listed",
    )
