"""Blocked ordered values equal plain windows, on any data."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from actiflow.operators import blocks
from actiflow.plans.activity import activity_from_tables, previous_order
from actiflow.plans.catalog import QUERIES
from conftest import SF_SMALL

BIG = 9007199254740993  # not a double
row = st.tuples(st.sampled_from([1, 2, None]), st.integers(0, 400),
                st.sampled_from([None, 1.5, math.nan, -0.25]), st.sampled_from([None, BIG, 7]))


def text(rows):
    return sorted(map(str, rows))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, max_size=40))
def test_previous_value_equals_window(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, g int, t long, v double, n long")
    w = Window.partitionBy("g").orderBy("t", "id")
    for source in ("v", "n"):
        got = blocks.previous_value(df, "g", ["t", "id"], F.floor(F.col("t") / 50), source, "prev")
        assert text(got.collect()) == text(df.withColumn("prev", F.lag(source).over(w)).collect())


def test_running_equals_window_at_every_level(spark, monkeypatch):
    keys = [0, 1, 5, 63, 64, 4095, 4096, 1 << 20, (1 << 40) + 3, (1 << 62), -9]
    df = spark.createDataFrame([(k, i if i % 3 else None) for i, k in enumerate(keys)], "k long, v long")
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumn("s", F.sum(F.coalesce("v", F.lit(0))).over(w)).withColumn(
        "n", F.count(F.lit(1)).over(w))
    for width in (2, 64, 1 << 16):
        monkeypatch.setattr(blocks, "WIDTH", width)
        got = blocks.running(df, "k", {"s": "v"}, "n")
        assert text(got.collect()) == text(want.collect())
    assert blocks.running(df.limit(0), "k", {"s": "v"}, "n").count() == 0


def test_customer_with_a_third_of_all_orders(spark):
    orders = spark.range(3000).select(
        F.col("id").alias("o_orderkey"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("o_custkey"),
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, CAST(id * 7 % 50 AS INT))").alias("o_orderdate"))
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    want = orders.withColumn("prev_orderdate", F.lag("o_orderdate").over(w))
    assert text(previous_order(orders).collect()) == text(want.collect())


def test_keys_beyond_32_bits(spark):
    key = (1 << 31) + 5
    orders = spark.sql(f"SELECT {key}L AS o_orderkey, {key}L AS o_custkey, 600D AS o_totalprice, "
                       "timestamp_ntz'2024-01-01' AS o_orderdate")
    lineitem = spark.sql(f"SELECT {key}L AS l_orderkey, 2D AS l_quantity, 0.1D AS l_discount")
    customer = spark.sql(f"SELECT {key}L AS c_custkey, 1 AS c_nationkey, 0D AS c_acctbal")
    got = activity_from_tables(orders, lineitem, customer, spark.sql("SELECT 1 AS n_nationkey, 'X' AS n_name"))
    assert [(r.customer_id, r.batch_id) for r in got.collect()] == [(key, key // 500)]


def test_building_activity_runs_no_job_and_no_python(spark):
    group = "activity-build"
    spark.sparkContext.setJobGroup(group, "build")
    try:
        df = QUERIES["activity"](spark, SF_SMALL)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInPandas" not in plan
