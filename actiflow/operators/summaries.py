"""Rollups: city, membership, segments and the per-batch KPI row.

All are single ``groupBy().agg()`` plans: partial aggregation runs before the
shuffle, so a hot group key costs one row per map task, not a hot reducer. Sums and means
are exact (``functions.exact``): they depend neither on the order of rows nor on how rows
were split over files, partitions or micro-batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actiflow.functions import exact

# The names of the result columns below.


def count_true(c) -> Column:
    """Conditional count; a null condition counts as false."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(F.when(col, F.lit(1)).otherwise(F.lit(0))).cast("long")


def city_summary(events: DataFrame, ordered: bool = True) -> DataFrame:
    """Per-city rollup; ``ordered=False`` for stored tables (no sort job)."""
    out = (events.groupBy("city")
           .agg(F.count(F.lit(1)).alias("event_count"),
                exact.mean("total_spend").alias("avg_total_spend"),
                F.sum("items_purchased").cast("long").alias("total_items_purchased")))
    return out.orderBy("city") if ordered else out


def membership_summary(enriched: DataFrame, ordered: bool = True) -> DataFrame:
    out = (enriched.groupBy("membership_type")
           .agg(F.count(F.lit(1)).alias("event_count"),
                exact.mean("total_spend").alias("avg_total_spend"),
                exact.mean("average_rating").alias("avg_rating"),
                F.sum("high_value_order").cast("long").alias("high_value_orders")))
    return out.orderBy("membership_type") if ordered else out


def segment_measures(decimals: int | None = 2) -> list[Column]:
    """Mean spend and item total of a segment, with explicit names.

    The dict-style API would name them ``avg(total_spend)`` and
    ``sum(items_purchased)``. ``decimals=None`` keeps the means unrounded.
    """
    return [exact.mean("total_spend", decimals).alias("avg_total_spend"),
            F.sum("items_purchased").cast("long").alias("total_items_purchased")]


def segment_state() -> list[Column]:
    """Mergeable state of a segment: what ``merge_segment_state`` adds up."""
    return [exact.total("total_spend").alias("spend_sum"), exact.count("total_spend").alias("spend_n"),
            F.sum("items_purchased").cast("long").alias("items_sum")]


def merge_segment_state(states: DataFrame, keys: list[str], decimals: int | None = 2) -> DataFrame:
    """Segments from any number of partial states per key (columns of ``customer_segments``
    or ``city_segments``)."""
    merged = states.groupBy(*keys).agg(exact.merged("spend_sum").alias("spend_sum"), F.sum("spend_n").alias("spend_n"),
                                       F.sum("items_sum").cast("long").alias("total_items_purchased"))
    return merged.select(*keys, exact.rounded_mean("spend_sum", "spend_n", decimals).alias("avg_total_spend"),
                         "total_items_purchased")


SEGMENT_KEYS = {
    "customer_segments": ["membership_type", "age_group", "city"],
    "city_segments": ["city"],
}


def customer_segments(with_age: DataFrame, decimals: int | None = 2) -> DataFrame:
    return with_age.groupBy(*SEGMENT_KEYS["customer_segments"]).agg(*segment_measures(decimals))


def city_segments(events: DataFrame, decimals: int | None = 2) -> DataFrame:
    return events.groupBy(*SEGMENT_KEYS["city_segments"]).agg(*segment_measures(decimals))


def kpi_measures() -> list[Column]:
    """The KPI aggregates of one batch, in one pass (no per-measure jobs)."""
    return [
        F.count(F.lit(1)).alias("event_count"),
        exact.rounded(exact.total("total_spend")).alias("total_revenue"),
        exact.mean("total_spend").alias("avg_spend"),
        exact.mean("average_rating").alias("avg_rating"),
        count_true("discount_applied").alias("discounted_orders"),
        F.sum("high_value_order").cast("long").alias("high_value_orders"),
        count_true("is_at_risk").alias("at_risk_count"),
    ]


def batch_kpi(enriched: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """One KPI row per batch (``GROUP BY batch_id``) over an enriched history."""
    return (enriched.groupBy(F.col(batch_col).cast("long").alias("batch_id"))
            .agg(*kpi_measures()))


def kpi_partials(enriched: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Mergeable KPI state per batch: counts and exact sums only (no means, no rounding).

    Partials of the same batch from different micro-batches are combined by
    ``merge_kpi_partials``; the result does not depend on how a batch's events
    were split over micro-batches.
    """
    return (enriched.groupBy(F.col(batch_col).cast("long").alias("batch_id"))
            .agg(F.count(F.lit(1)).alias("event_count"),
                 exact.total("total_spend").alias("spend_sum"),
                 exact.count("total_spend").alias("spend_n"),
                 exact.total("average_rating").alias("rating_sum"),
                 exact.count("average_rating").alias("rating_n"),
                 count_true("discount_applied").alias("discounted_orders"),
                 F.sum("high_value_order").cast("long").alias("high_value_orders"),
                 count_true("is_at_risk").alias("at_risk_count")))


def merge_kpi_partials(parts: DataFrame) -> DataFrame:
    """Combine partials into one KPI row per batch (same columns as ``batch_kpi``)."""
    m = (parts.groupBy(F.col("batch_id").cast("long").alias("batch_id"))
         .agg(F.sum("event_count").cast("long").alias("event_count"),
              exact.merged("spend_sum").alias("spend_sum"), F.sum("spend_n").alias("spend_n"),
              exact.merged("rating_sum").alias("rating_sum"), F.sum("rating_n").alias("rating_n"),
              F.sum("discounted_orders").cast("long").alias("discounted_orders"),
              F.sum("high_value_orders").cast("long").alias("high_value_orders"),
              F.sum("at_risk_count").cast("long").alias("at_risk_count"),
              *([F.max("processed_at").alias("processed_at")]
                if "processed_at" in parts.columns else [])))
    return finished_kpis(m, ["processed_at"] if "processed_at" in parts.columns else [])


def finished_kpis(merged: DataFrame, extra: list[str]) -> DataFrame:
    """KPI rows from one merged partial per batch (with the ``extra`` columns)."""
    return merged.select(
        *extra, "batch_id", "event_count",
        exact.rounded("spend_sum").alias("total_revenue"),
        exact.rounded_mean("spend_sum", "spend_n").alias("avg_spend"),
        exact.rounded_mean("rating_sum", "rating_n").alias("avg_rating"),
        "discounted_orders", "high_value_orders", "at_risk_count")
