"""Sketches per source file: what they hold, that they merge, and that only due files are read."""

import math
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ontime.operators import column_sketches, merge_sketches, sketched_profile
from ontime.plans import cleaning_job, due_sketches, read_sketches, sketch_cleaned, sketching
from ontime.plans.flights import ROW_KEY
from ontime.queries import stages


@pytest.fixture(scope="module")
def table(spark):
    """Seven files of very different sizes, nulls, NaN and infinity among the cells."""
    rows = spark.range(60_000).select(
        F.concat(F.lit("f"), F.least(F.floor(F.log2(F.col("id") + 2)), F.lit(6)).cast("string")).alias("file"),
        F.when(F.col("id") % 11 == 0, None).otherwise((F.col("id") * 7919 % 60_013).cast("double")).alias("x"),
        F.when(F.col("id") % 5 == 0, float("nan")).when(F.col("id") == 7, float("inf")).otherwise(F.sqrt("id")).alias("y"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4000)).alias("t"),
        F.lit(None).cast("string").alias("none"),
    )
    return rows.repartition(6).persist()


@pytest.fixture(scope="module")
def sketches(table):
    return column_sketches(table, "file", ["x", "y"], ["t", "none"]).persist()


def test_merged_sketches_are_near_the_whole_table(table, sketches):
    made = {r["column"]: r for r in sketched_profile(sketches).collect()}
    data = table.select("x", "y", "t").toPandas()
    xs = sorted(v for v in data.x if not math.isnan(v))
    assert made["x"].n_rows == 60_000 and made["x"].n_values == len(xs)
    assert (made["x"].min, made["x"].max) == (xs[0], xs[-1]) and made["x"].mean == pytest.approx(sum(xs) / len(xs))
    for mark, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert abs(xs.index(made["x"][mark]) - p * len(xs)) < 0.01 * len(xs)
    assert made["y"].max == float("inf") and made["y"].n_values == int(data.y.notna().sum())
    assert abs(made["x"].n_distinct - len(set(xs))) < 0.06 * len(set(xs))
    distinct = data.t.nunique()
    assert abs(made["t"].n_distinct - distinct) < 0.06 * distinct
    assert (made["t"].min_text, made["t"].max_text) == (data.t.min(), data.t.max()) and made["t"].p50 is None


def test_any_set_of_files(table, sketches):
    some = ["f1", "f4", "f6"]
    made = {r["column"]: r for r in sketched_profile(sketches.filter(F.col("file").isin(some))).collect()}
    part = table.filter(F.col("file").isin(some)).select("x").dropna().toPandas().x
    assert made["x"].n_values == len(part) and made["x"].max == part.max()
    assert abs((part < made["x"].p50).mean() - 0.5) < 0.01
    by_file = sketched_profile(sketches, ["file"]).filter("column = 'x'").collect()
    assert sum(r.n_values for r in by_file if r.file in some) == len(part)


def test_merging_in_steps_changes_no_exact_part(sketches):
    exact = ["column", "kind", "n_rows", "n_values", "low", "high", "low_text", "high_text"]
    halves = [merge_sketches(sketches.filter(c)) for c in ("file < 'f4'", "file >= 'f4'")]
    twice = merge_sketches(halves[0].unionByName(halves[1]))
    assert {tuple(r) for r in twice.select(exact).collect()} == {tuple(r) for r in merge_sketches(sketches).select(exact).collect()}
    # Registers of distinct counts take the greater value: the same whatever the order.
    counts = [
        {r["column"]: r.n for r in s.select("column", F.hll_sketch_estimate("distinct").alias("n")).collect()}
        for s in (twice, merge_sketches(sketches))
    ]
    assert counts[0]["t"] == pytest.approx(counts[1]["t"], rel=0.03)


def test_columns_without_values(sketches):
    row = sketched_profile(sketches).filter("column = 'none'").first()
    assert (row.n_rows, row.n_values, row.n_distinct, row["mean"], row.p50) == (60_000, 0, 0, None, None)


def test_empty_table(spark, table):
    assert sketched_profile(column_sketches(table.limit(0), "file", ["x"], ["t"])).count() == 0


def test_rows_are_aggregated_as_rows(table):
    """One group per file: no cell becomes a row before the aggregate, which would sort
    its input beyond 128 groups in a task."""
    names = [f"t{i}" for i in range(70)]
    wide = table.select("file", "x", *[F.col("t").alias(n) for n in names])
    made = column_sketches(wide, "file", ["x"], names)
    plan = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
    kinds = [line.strip(" +-:").split(" ")[0] for line in plan]
    assert kinds.index("Generate") < kinds.index("Aggregate") and "Generate" not in kinds[kinds.index("Aggregate") :]
    counts = {(r["file"], r["column"]): (r["kind"], r["n_rows"], r["n_values"]) for r in made.collect()}
    rows = {r["file"]: (r["n"], r["x"], r["t"]) for r in table.groupBy("file").agg(F.count("*").alias("n"), F.count("x").alias("x"), F.count("t").alias("t")).collect()}
    assert len(counts) == 71 * len(rows)
    for (file, column), found in counts.items():
        n, x, t = rows[file]
        assert found == (("number", n, x) if column == "x" else ("text", n, t))


@pytest.fixture
def root(spark, sf_dir, tmp_path):
    records = stages.raw(spark, sf_dir).filter(F.col("ActualElapsedTime") >= 0).limit(160).toArrow()
    (tmp_path / "landing").mkdir()
    for i in range(3):
        put(tmp_path, i, records.slice(40 * i, 40))
    return tmp_path, records


def put(folder, i, records):
    pq.write_table(records, folder / "landing" / f"f{i}.parquet")


def written(folder):
    return {p.name: max(f.stat().st_mtime_ns for f in p.glob("*.parquet")) for p in (folder / "sketches").glob("source_file=*")}


def test_only_due_files_are_sketched(spark, root, monkeypatch):
    folder, records = root
    clean = lambda: cleaning_job(spark, str(folder), carry=[ROW_KEY])
    assert sketch_cleaned(spark, str(folder)) == [] and read_sketches(spark, str(folder)).count() == 0
    clean()
    assert sketch_cleaned(spark, str(folder)) == ["f0.parquet", "f1.parquet", "f2.parquet"]
    before = written(folder)
    assert sketch_cleaned(spark, str(folder)) == [] and written(folder) == before
    time.sleep(0.02)
    put(folder, 1, records.slice(100, 20))
    put(folder, 3, records.slice(120, 40))
    clean()

    seen = []
    sketch = sketching.column_sketches
    monkeypatch.setattr(sketching, "column_sketches", lambda df, *rest: seen.append(df) or sketch(df, *rest))
    assert sketch_cleaned(spark, str(folder)) == ["f1.parquet", "f3.parquet"]
    scan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [source_file" in scan and "f3.parquet" in scan and "f0.parquet" not in scan
    after = written(folder)
    assert {n for n in after if after[n] != before.get(n)} == {"source_file=f1.parquet", "source_file=f3.parquet"}
    zone = spark.read.parquet(f"{folder}/cleaned")
    for row in sketched_profile(read_sketches(spark, str(folder))).filter("kind = 'number'").collect():
        assert row.n_rows == zone.count()
        assert row.max == zone.agg(F.max(row["column"])).first()[0]


def test_a_file_without_clean_rows_counts_zero(spark, root):
    folder, records = root
    at = records.schema.get_field_index("ActualElapsedTime")
    put(folder, 2, records.slice(0, 10).set_column(at, records.schema.field(at), pa.array([-1.0] * 10, records.schema.field(at).type)))
    cleaning_job(spark, str(folder), carry=[ROW_KEY])
    sketch_cleaned(spark, str(folder), batch_files=2)
    rows = read_sketches(spark, str(folder)).filter("source_file = 'f2.parquet'").collect()
    assert len(rows) == 44 and all(r.n_rows == 0 and r.quantiles is None for r in rows)
    assert due_sketches(spark, str(folder)).count() == 0
