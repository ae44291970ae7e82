"""Vectors are described by the cells that are not zero."""

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ontime.operators.encode import FEATURES, vector_name
from ontime.queries import learning
from ontime.queries.tables import CATEGORIES

WIDTH = 3


def sample(spark):
    """A row whose categories fire slots 0, 1, 2, none, 0, ...; as dense and sparse vector."""
    values = []
    for i in range(len(CATEGORIES)):
        values += [1.0 if i % 4 == j else 0.0 for j in range(WIDTH)]
    dense = Vectors.dense([*values, 0.0, 0.1234567])
    sparse = Vectors.sparse(len(dense), [(i, x) for i, x in enumerate(dense) if x])
    attrs = lambda n: {"ml_attr": {"num_attrs": n}}
    df = spark.createDataFrame([("d", dense), ("s", sparse)], ["RowKey", FEATURES])
    df = df.withColumn(FEATURES, F.col(FEATURES).alias(FEATURES, metadata=attrs(len(dense))))
    return df.withColumns({vector_name(c): F.col(FEATURES).alias(vector_name(c), metadata=attrs(WIDTH)) for c in CATEGORIES})


def test_descriptions_without_making_zeros(spark):
    described = learning.describe_vectors(sample(spark))
    rows = {r.RowKey: tuple(r)[1:] for r in described.collect()}
    slots = "|".join(str(i * WIDTH + (i % 4 if i % 4 < WIDTH else -1)) for i in range(len(CATEGORIES)))
    assert rows["d"] == rows["s"] == (len(CATEGORIES) * WIDTH + 2, slots, 0.0, 0.123457)
    # One array of zeros and all per use of the vector is what the plan had before.
    assert "UDF(features" not in described._jdf.queryExecution().optimizedPlan().toString()


def test_slots_of_the_baseline_come_from_cells(spark, sf_dir):
    plan = learning.balanced_slots(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan
