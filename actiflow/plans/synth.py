"""Event synthesis as a Spark job (the reference looped over rows on one machine).

``synth_events`` samples seed rows with replacement and perturbs them;
``synth_messages`` draws unconditioned CSV messages. Both use hashed uniforms
(``functions.hashing``), so a row's values depend only on (seed, index), never
on partitioning, and the output can be recomputed in SQL.

Sampling is an equi-join of event indices to the seed on a dense row number,
not a broadcast: the seed (here: the activity table) grows with the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actiflow.functions import hashing, rules

# ---------------------------------------------------------------------------
# Fixed values (generator rules).
#   spend  + uniform(-90, 140), round 2, at least 120
#   items  + randint(-2, 3), at least 1
#   rating + uniform(-0.4, 0.5), round 1, then within [2.8, 5.0]
#   days   + randint(-6, 8), at least 1
#   discount flipped with probability 0.25
#   age    + randint(-1, 1), within [18, 70]
#   id 'evt-%06d' of the 1-based event index; satisfaction recomputed (rule A)
# Messages: id randint(101, 999); age randint(18, 65); spend uniform(400, 1500)
#   round 2; items randint(8, 19); rating uniform(3.0, 4.7) round 1; discount
#   50/50; days randint(12, 55); satisfaction rule B.
# ---------------------------------------------------------------------------
GENDERS = ["Male", "Female"]
CITIES = ["New York", "Los Angeles", "Chicago", "San Francisco", "Miami", "Houston"]
TIERS = ["Gold", "Silver", "Bronze"]
DEFAULT_SEED = 42
DEFAULT_BASE_TIME = dt.datetime(2024, 1, 1)


def synth_events(seed_rows: DataFrame, indices: DataFrame, seed: int = DEFAULT_SEED,
                 batch_size: int = 20, pause_seconds: int = 5,
                 base_time: dt.datetime = DEFAULT_BASE_TIME) -> DataFrame:
    """One event per row of ``indices`` (column ``i``, 1-based).

    ``seed_rows`` needs a dense ``row_no`` (0..n-1) and the seed fields
    customer_id, gender, age, city, membership_type, total_spend,
    items_purchased, average_rating, discount_applied, days_since_last_purchase.
    """
    # The number of seed rows is a scalar subquery: no job runs while the query is built, and
    # an empty seed fails when an event is drawn from it.
    n_seed = seed_rows.agg(F.count(F.lit(1)).alias("n")).select(
        F.when(F.col("n") > 0, F.col("n")).otherwise(F.raise_error(F.lit("empty seed")).cast("long"))).scalar()
    picks = indices.select("i").withColumn(
        "row_no", F.floor(hashing.uniform(seed, "i", "pick") * n_seed).cast("long"))
    base = picks.join(seed_rows, "row_no")
    i = F.col("i")
    spend = F.round(F.col("total_spend") + hashing.uniform_between(seed, i, "spend", -90.0, 140.0), 2)
    rating = F.round(F.col("average_rating")
                     + hashing.uniform_between(seed, i, "rating", -0.4, 0.5), 1)
    flip = hashing.uniform(seed, i, "flip") < F.lit(0.25)
    batch_no = (F.floor((i - 1) / batch_size) + 1).cast("long")
    out = base.select(
        F.format_string("evt-%06d", i).alias("event_id"),
        F.timestamp_add("SECOND", (batch_no - 1) * pause_seconds,
                        F.lit(base_time).cast("timestamp_ntz")).alias("event_time"),
        F.col("customer_id"), F.col("gender"),
        rules.clamp(F.col("age") + hashing.randint(seed, i, "age", -1, 1), 18, 70).alias("age"),
        F.col("city"), F.col("membership_type"),
        rules.clamp(spend, lo=120.0).alias("total_spend"),
        rules.clamp(F.col("items_purchased") + hashing.randint(seed, i, "items", -2, 3), lo=1)
        .alias("items_purchased"),
        rules.clamp(rating, 2.8, 5.0).alias("average_rating"),
        (F.col("discount_applied") != flip).alias("discount_applied"),
        rules.clamp(F.col("days_since_last_purchase") + hashing.randint(seed, i, "days", -6, 8),
                    lo=1).alias("days_since_last_purchase"),
        batch_no.alias("batch_no"),
    )
    return out.withColumn("satisfaction_level", rules.satisfaction_a()).select(
        "event_id", "event_time", "customer_id", "gender", "age", "city", "membership_type",
        "total_spend", "items_purchased", "average_rating", "discount_applied",
        "days_since_last_purchase", "satisfaction_level", "batch_no")


def synth_messages(indices: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """One unconditioned CSV-message row per row of ``indices`` (column ``i``)."""
    i = F.col("i")
    rating = F.round(hashing.uniform_between(seed, i, "rating", 3.0, 4.7), 1)
    return indices.select(
        i.cast("long").alias("i"),
        hashing.randint(seed, i, "customer", 101, 999).alias("customer_id"),
        hashing.choice(seed, i, "gender", GENDERS).alias("gender"),
        hashing.randint(seed, i, "age", 18, 65).alias("age"),
        hashing.choice(seed, i, "city", CITIES).alias("city"),
        hashing.choice(seed, i, "tier", TIERS).alias("membership_type"),
        F.round(hashing.uniform_between(seed, i, "spend", 400.0, 1500.0), 2).alias("total_spend"),
        hashing.randint(seed, i, "items", 8, 19).alias("items_purchased"),
        rating.alias("average_rating"),
        (hashing.uniform(seed, i, "discount") < F.lit(0.5)).alias("discount_applied"),
        hashing.randint(seed, i, "days", 12, 55).alias("days_since_last_purchase"),
        rules.satisfaction_b(rating).alias("satisfaction_level"),
    )


def typed_seed(raw_seed: DataFrame) -> DataFrame:
    """Header-named text seed (CSV) -> typed seed fields; bad numbers -> null."""
    def num(name, t):
        return F.col(name).try_cast(t)
    return raw_seed.select(
        num("Customer ID", "int").alias("customer_id"),
        F.col("Gender").alias("gender"),
        num("Age", "int").alias("age"),
        F.col("City").alias("city"),
        F.col("Membership Type").alias("membership_type"),
        num("Total Spend", "double").alias("total_spend"),
        num("Items Purchased", "int").alias("items_purchased"),
        num("Average Rating", "double").alias("average_rating"),
        rules.parse_bool("Discount Applied").alias("discount_applied"),
        num("Days Since Last Purchase", "int").alias("days_since_last_purchase"),
        F.col("Satisfaction Level").alias("satisfaction_level"),
    )
