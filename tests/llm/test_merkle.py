"""The Merkle manifest against a plain tree in Python, on odd and many rows."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from ontime.llm.merkle import fold, leaf_digest, manifest, proof


def plain_digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return plain_digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes):
    """The top node, and per leaf the (left, right) strings of every level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i // 16 * 16
            paths[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 16])))
        nodes = [plain_digest(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return nodes[0], paths


def plain_manifest(rows):
    """(id, leaf, subroot, root, siblings) per row of (id, source, leaf)."""
    groups = {}
    for doc_id, source, leaf in rows:
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    root, crown = plain_tree([trees[s][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for (_, _, leaf, doc_id), path in zip(sorted(groups[s], key=lambda x: x[:3]), trees[s][1], strict=True):
            out.append((doc_id, leaf, trees[s][0], root, "".join(a + b for a, b in [*path, *crown[at]])))
    return out


def found(rows):
    table = manifest(rows).withColumns({"proof": proof(F.col("path")), "folded": fold(F.col("leaf"), F.col("path"))})
    got = table.collect()
    assert all(r["folded"] == r["root"] for r in got)
    return [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"]) for r in got]


def order(row):
    return (row[0] is not None, row)


@pytest.mark.parametrize("sizes", [[1], [17, 2], [256, 16, 1], [4097, 300]])
def test_sizes_against_plain_trees(spark, sizes):
    rng = random.Random(sum(sizes))
    rows = [(i * 7 + s, f"s{s}", plain_digest(str(rng.random()))) for s, n in enumerate(sizes) for i in range(n)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, source string, leaf string").repartition(5)
    assert sorted(found(table)) == sorted(plain_manifest(rows))


def test_many_sources_and_ties(spark):
    """Null ids and sources, names that sort by bytes, equal ids, repeated rows."""
    names = [None, "", "a", "B", "é", "\x00", *[f"n{i}" for i in range(300)]]
    rows = [(i % 5 if i % 7 else None, names[i % len(names)], plain_digest(str(i % 900))) for i in range(1500)]
    rows += [(3, "hot", plain_digest("same"))] * 1200
    table = spark.createDataFrame(rows, "doc_id long, source string, leaf string").repartition(7)
    assert sorted(found(table), key=lambda r: (r[0] is not None, r[0] or 0, r[1:])) == sorted(
        plain_manifest(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1:])
    )


def test_odd_rows(spark, odd_documents, no_documents):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    leaves = odd_documents.withColumn("leaf", leaf_digest([F.col(f) for f in fields])).withColumnRenamed("tokens", "place")
    got = manifest(leaves)
    assert got.columns == [*leaves.columns, "subroot", "root", "path"]
    given = [tuple(r[f] for f in fields) for r in odd_documents.collect()]
    assert sorted(r["leaf"] for r in got.collect()) == sorted(plain_leaf(v) for v in given)
    wanted = plain_manifest([(v[0], v[1], plain_leaf(v)) for v in given])
    assert {r["root"] for r in got.collect()} == {wanted[0][3]}
    assert manifest(leaves.filter("doc_id = -1")).count() == 0
    with pytest.raises(ValueError, match="root"):
        manifest(leaves.withColumn("Root", F.lit(1)))


def test_tampering_shows(spark):
    rows = [(i, "s", plain_digest(str(i))) for i in range(40)]
    table = manifest(spark.createDataFrame(rows, "doc_id long, source string, leaf string"))
    other = F.when(F.col("doc_id") == 7, F.sha2(F.lit("x"), 256)).otherwise(F.col("leaf"))
    wrong = table.filter(fold(other, F.col("path")) != F.col("root")).collect()
    assert [r["doc_id"] for r in wrong] == [7]
