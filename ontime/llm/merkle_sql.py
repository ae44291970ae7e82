"""The Merkle manifest of ``documents`` as DuckDB SQL, a fixed number of levels deep."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Levels that the SQL can climb: 16^6 documents a source, 16^4 sources.
SOURCE_LEVELS, TOP_LEVELS = 6, 4

# crc32 of the decimal id: eight shifts after each byte.
CRC32 = """xor(list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''),
  lambda s: [ascii(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END,
  4294967295::BIGINT), 4294967295::BIGINT)"""


def written(*values: str) -> str:
    return " || ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values)


def levels(name: str, count: int) -> str:
    """From ``{name}0`` (nodes: g, i, h, n) and ``{name}p0`` (rows: k, g, i, folded,
    proof) to those of the last level."""
    parts = []
    for j in range(count):
        t, p, up = f"{name}{j}", f"{name}p{j}", j + 1
        parts.append(f"""
{t}g AS (SELECT g, i // 16 AS b, n, list(h ORDER BY i) AS hs FROM {t} GROUP BY g, i // 16, n),
{name}{up} AS (
 SELECT g, b AS i, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h,
  CASE WHEN n > 1 THEN (n + 15) // 16 ELSE 1 END AS n FROM {t}g),
{name}p{up} AS (
 SELECT k, p.g, i // 16 AS i,
  CASE WHEN n > 1 THEN sha256(array_to_string(hs[1 : i % 16], '') || folded || array_to_string(hs[i % 16 + 2 : 16], '')) ELSE folded END AS folded,
  proof || array_to_string(hs[1 : i % 16], '') || array_to_string(hs[i % 16 + 2 : 16], '') AS proof
 FROM {p} p JOIN {t}g q ON p.g IS NOT DISTINCT FROM q.g AND p.i // 16 = q.b)""")
    return ",".join(parts)


MERKLE_SQL = f"""
WITH d AS (
 SELECT row_number() OVER () AS k, doc_id, source, sha256({written("doc_id", "source", "lang", "n_chars", "text")}) AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {CRC32} % 5 = 0
   THEN sha256({written("doc_id", "source", "lang", "n_chars", f"translate(text, '{UPPER}', '{UPPER.lower()}')")})
   ELSE sha256({written("doc_id", "source", "lang", "n_chars", "text")}) END AS changed
 FROM documents),
r AS (
 SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
  count(*) OVER (PARTITION BY source) AS n FROM d),
s0 AS (SELECT source AS g, i, leaf AS h, n FROM r),
sp0 AS (SELECT k, source AS g, i, changed AS folded, '' AS proof FROM r),{levels("s", SOURCE_LEVELS)},
t0 AS (
 SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, h, count(*) OVER () AS n, g AS source FROM s{SOURCE_LEVELS}),
tp0 AS (
 SELECT k, 0 AS g, t0.i, folded, proof FROM sp{SOURCE_LEVELS} p JOIN t0 ON p.g IS NOT DISTINCT FROM t0.source),{levels("t", TOP_LEVELS)}
SELECT doc_id, leaf, u.h AS subroot, w.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = w.h AS verified
FROM d JOIN tp{TOP_LEVELS} p USING (k) JOIN t0 u ON d.source IS NOT DISTINCT FROM u.source CROSS JOIN t{TOP_LEVELS} w"""
