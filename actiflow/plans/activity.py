"""The ``activity`` mapping: customer-activity events derived from the order tables.

One event per order. Customer attributes come from ``customer``/``nation``, the
basket from ``lineitem`` and the recency from the customer's previous order.

Plan shape (checked with ``explain("formatted")``):
  * lineitem is reduced to one row per order with a partial + final hash
    aggregate before it is shuffled;
  * the previous order per customer comes from windows within (customer, day) and one
    tail row per customer and day, so one customer with a third of all orders does not
    become one task;
  * ``customer`` and ``nation`` are joined by the planner (broadcast when small by measured
    size, else sort-merge with AQE skew splitting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actiflow.functions import rules
from actiflow.operators.blocks import previous_value
from actiflow.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the mapping (shared with the SQL oracle).
#   gender:      c_custkey even -> 'Female', odd -> 'Male'
#   age:         null when c_custkey % 17 = 0, else 18 + (c_custkey * 7) % 53
#   membership:  c_acctbal >= 6000 'Gold'; >= 2500 'Silver'; else 'Bronze'
#   spend:       o_totalprice / 300
#   rating:      (28 + (o_orderkey * 37) % 23) / 10
#   discount:    max(l_discount) of the order > 0.09
#   days:        1 + (days since the customer's previous order) % 60
#   batch:       floor(o_orderkey / 500)
#   event id:    'evt-%06d' of o_orderkey
# ---------------------------------------------------------------------------
GOLD_BALANCE = 6000
SILVER_BALANCE = 2500
SPEND_DIVISOR = 300
DISCOUNT_OVER = 0.09
DAYS_MODULUS = 60
ORDERS_PER_BATCH = 500
EVENT_ID_FORMAT = "evt-%06d"

ACTIVITY_COLUMNS = ["event_id", "event_time", "customer_id", "gender", "age", "city",
                    "membership_type", "total_spend", "items_purchased", "average_rating",
                    "discount_applied", "days_since_last_purchase", "satisfaction_level",
                    "o_orderkey", "batch_id"]


def basket_per_order(lineitem: DataFrame) -> DataFrame:
    return (lineitem.groupBy("l_orderkey")
            .agg(F.sum("l_quantity").cast("int").alias("items"),
                 F.max("l_discount").alias("max_disc")))


def previous_order(orders: DataFrame) -> DataFrame:
    """Orders with the date of the same customer's previous order (no hot task)."""
    return previous_value(orders, "o_custkey", ["o_orderdate", "o_orderkey"],
                          F.to_date("o_orderdate"), "o_orderdate", "prev_orderdate",
                          nulls=False)  # orders without a customer are not events


def activity_from_tables(orders: DataFrame, lineitem: DataFrame, customer: DataFrame,
                         nation: DataFrame) -> DataFrame:
    orders = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    li = basket_per_order(lineitem.select("l_orderkey", "l_quantity", "l_discount"))
    cust = (customer.select("c_custkey", "c_nationkey", "c_acctbal")
            .join(nation.select("n_nationkey", "n_name"),
                  F.col("c_nationkey") == F.col("n_nationkey")))
    base = (previous_order(orders)
            .join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left"))

    key = F.col("c_custkey")
    days = (F.lit(1) + F.datediff(F.col("o_orderdate"), F.col("prev_orderdate")) % DAYS_MODULUS)
    out = base.select(
        F.format_string(EVENT_ID_FORMAT, F.col("o_orderkey")).alias("event_id"),
        F.col("o_orderdate").alias("event_time"),
        key.alias("customer_id"),
        F.when(key % 2 == 0, F.lit("Female")).otherwise(F.lit("Male")).alias("gender"),
        F.when(key % 17 == 0, F.lit(None).cast("int"))
         .otherwise((F.lit(18) + (key * 7) % 53).cast("int")).alias("age"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_acctbal") >= GOLD_BALANCE, F.lit("Gold"))
         .when(F.col("c_acctbal") >= SILVER_BALANCE, F.lit("Silver"))
         .otherwise(F.lit("Bronze")).alias("membership_type"),
        (F.col("o_totalprice") / SPEND_DIVISOR).alias("total_spend"),
        F.col("items").alias("items_purchased"),
        ((F.lit(28) + (F.col("o_orderkey") * 37) % 23).cast("double") / 10).alias("average_rating"),
        (F.col("max_disc") > DISCOUNT_OVER).alias("discount_applied"),
        days.cast("int").alias("days_since_last_purchase"),
        F.col("o_orderkey"),
        F.floor(F.col("o_orderkey") / ORDERS_PER_BATCH).cast("long").alias("batch_id"),
    )
    out = out.withColumn("satisfaction_level", rules.satisfaction_a())
    return out.select(*ACTIVITY_COLUMNS)


def load_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_from_tables(
        read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"),
        read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "nation"))
