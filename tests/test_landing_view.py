"""The landing table is made with one narrow shuffle of the order lines."""

from datetime import datetime

import pytest

from ontime.plans import flights
from ontime.queries import stages
from ontime.session import METHOD_CONF


@pytest.fixture()
def orders_root(spark, tmp_path):
    day = datetime(1996, 5, 17)
    tables = {
        "lineitem": ([(1, 7, 3, 1, 5.0, 900.0), (1, 8, 3, 2, 9.0, 70.0), (2, 9, 4, 1, 1.0, 10.0), (None, 9, 4, 1, 1.0, 10.0)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"),
        "orders": ([(1, 5, day), (2, 6, day), (2, 6, day)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "customer": ([(5, 0), (6, 1), (None, 1)], "c_custkey long, c_nationkey int"),
        "supplier": ([(3, 0), (4, 1)], "s_suppkey long, s_nationkey int"),
        "nation": ([(0, "A", 0), (1, "B", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_dealt_out_once(spark, orders_root):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(flights(spark, orders_root))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Orders and customers by customer; the lines by order, then only by supplier.
    assert text.count("hashpartitioning(o_custkey") == 1
    assert text.count("hashpartitioning(o_orderkey") == 1
    joined = text[: text.index("hashpartitioning(l_orderkey")]
    assert "o_custkey" not in joined


def test_landing_is_written_without_a_shuffle_of_its_rows(spark, orders_root, monkeypatch):
    seen = {}

    def write(df, root, zone, **options):
        seen["plan"], seen["limit"] = plan(df), spark.conf.get(METHOD_CONF)
        return real(df, root, zone, **options)

    real = stages.write_zone
    monkeypatch.setattr(stages, "write_zone", write)
    limit = spark.conf.get(METHOD_CONF)
    rows = stages.raw(spark, orders_root)
    assert "hashpartitioning(RowKey" not in seen["plan"]
    # Its 45 columns are more code than the JVM compiles in one method.
    assert seen["limit"] == "8000" and spark.conf.get(METHOD_CONF) == limit
    # Two orders of one key double their line; a line without an order goes.
    assert sorted(r.RowKey for r in rows.collect()) == ["1|7|3|1", "1|8|3|2", "2|9|4|1", "2|9|4|1"]
