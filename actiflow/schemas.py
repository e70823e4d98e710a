"""Declared schemas: streams and stored results are never schema-inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the event, message and risk tables are contracts.
# One customer-activity event (JSON line). The first three fields are keys; Spark
# does not enforce non-null on read, so validity is checked by ``split_valid``.
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), True),
    T.StructField("event_time", T.StringType(), True),
    T.StructField("customer_id", T.IntegerType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("membership_type", T.StringType(), True),
    T.StructField("total_spend", T.DoubleType(), True),
    T.StructField("items_purchased", T.IntegerType(), True),
    T.StructField("average_rating", T.DoubleType(), True),
    T.StructField("discount_applied", T.BooleanType(), True),
    T.StructField("days_since_last_purchase", T.IntegerType(), True),
    T.StructField("satisfaction_level", T.StringType(), True),
])

EVENT_FIELDS = [f.name for f in EVENT_SCHEMA.fields]
EVENT_KEYS = ["event_id", "event_time", "customer_id"]

# The 11-field CSV message of the older pipeline: no id, no time, 32-bit floats.
CSV_MESSAGE_TYPES = [
    ("customer_id", "INT"), ("gender", "STRING"), ("age", "INT"), ("city", "STRING"),
    ("membership_type", "STRING"), ("total_spend", "FLOAT"), ("items_purchased", "INT"),
    ("average_rating", "FLOAT"), ("discount_applied", "BOOLEAN"),
    ("days_since_last_purchase", "INT"), ("satisfaction_level", "STRING"),
]
CSV_MESSAGE_DDL = ", ".join(f"{name} {kind}" for name, kind in CSV_MESSAGE_TYPES)
CSV_MESSAGE_FIELDS = [name for name, _ in CSV_MESSAGE_TYPES]

# Seed table of the generator: header CSV, read as text; ``typed_seed`` types the columns.
SEED_SCHEMA = T.StructType([
    T.StructField("Customer ID", T.StringType(), True),
    T.StructField("Gender", T.StringType(), True),
    T.StructField("Age", T.StringType(), True),
    T.StructField("City", T.StringType(), True),
    T.StructField("Membership Type", T.StringType(), True),
    T.StructField("Total Spend", T.StringType(), True),
    T.StructField("Items Purchased", T.StringType(), True),
    T.StructField("Average Rating", T.StringType(), True),
    T.StructField("Discount Applied", T.StringType(), True),
    T.StructField("Days Since Last Purchase", T.StringType(), True),
    T.StructField("Satisfaction Level", T.StringType(), True),
])

# Kafka source frame (the connector's fixed schema); only ``value`` is decoded.
KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
])

KPI_SCHEMA = T.StructType([
    T.StructField("processed_at", T.TimestampType(), True),
    T.StructField("batch_id", T.LongType(), True),
    T.StructField("processed_batches", T.LongType(), True),
    T.StructField("event_count", T.LongType(), True),
    T.StructField("cumulative_event_count", T.LongType(), True),
    T.StructField("total_revenue", T.DoubleType(), True),
    T.StructField("avg_spend", T.DoubleType(), True),
    T.StructField("avg_rating", T.DoubleType(), True),
    T.StructField("discounted_orders", T.LongType(), True),
    T.StructField("high_value_orders", T.LongType(), True),
    T.StructField("at_risk_count", T.LongType(), True),
])

CITY_SUMMARY_SCHEMA = T.StructType([
    T.StructField("city", T.StringType(), True),
    T.StructField("event_count", T.LongType(), True),
    T.StructField("avg_total_spend", T.DoubleType(), True),
    T.StructField("total_items_purchased", T.LongType(), True),
])

MEMBERSHIP_SUMMARY_SCHEMA = T.StructType([
    T.StructField("membership_type", T.StringType(), True),
    T.StructField("event_count", T.LongType(), True),
    T.StructField("avg_total_spend", T.DoubleType(), True),
    T.StructField("avg_rating", T.DoubleType(), True),
    T.StructField("high_value_orders", T.LongType(), True),
])

AT_RISK_COLUMNS = ["event_time", "customer_id", "city", "membership_type", "total_spend",
                   "average_rating", "days_since_last_purchase", "satisfaction_level"]
AT_RISK_CLASSIC_COLUMNS = ["customer_id", "city", "total_spend", "days_since_last_purchase",
                           "satisfaction_level"]
