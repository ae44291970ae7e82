"""The cells of a vector are taken without lambdas."""

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.operators import chi_square, stats


def test_cells_of_all_kinds_of_vectors(spark):
    rows = [
        ("dense", Vectors.dense([0.0, -1.5, 2.0])),
        ("sparse", Vectors.sparse(3, {1: -1.5, 2: 2.0})),
        ("kept zero", Vectors.sparse(3, [0, 2], [0.0, 4.0])),
        ("nan", Vectors.dense([float("nan"), 0.0, -0.0])),
        ("empty", Vectors.dense([])),
        ("no cells", Vectors.sparse(3, {})),
        ("null", None),
    ]
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", VectorUDT())])
    df = spark.createDataFrame(rows, schema).repartition(2)
    held = df.select("k", F.inline_outer(stats.held_cells(F.col("v")))).toDF("k", "idx", "value").filter("value != 0")
    given = df.select("k", F.inline(stats.slot_cells(F.col("v"))))
    assert sorted(map(str, held.collect())) == sorted(map(str, given.collect()))
    assert "lambda" not in held._jdf.queryExecution().optimizedPlan().toString()
    assert {r["k"] for r in held.collect()} == {"dense", "sparse", "kept zero", "nan"}


def test_same_table_dense_and_sparse(spark):
    values = [([float(i % 3), 0.0, float(i % 5 == 0)], float(i % 2)) for i in range(60)]
    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
    found = []
    for make in (Vectors.dense, lambda x: Vectors.sparse(3, {i: v for i, v in enumerate(x) if v})):
        table = [(y, make(x)) for x, y in values] + [(1.0, None), (None, make([9.0, 9.0, 9.0]))]
        found.append([tuple(r) for r in chi_square(spark.createDataFrame(table, schema)).orderBy("idx").collect()])
    assert found[0] == found[1] and [r[3] for r in found[0]] == [2, 0, 1]
