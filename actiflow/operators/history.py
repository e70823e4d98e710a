"""Running values over the batch history (replaces driver-held counters).

The reference kept ``processed_batches`` and ``cumulative_event_count`` in
driver memory, so they restarted at 0 with the process. Here they are derived
from the stored per-batch KPI rows, so a restart or a replayed batch cannot
make them drift. The running total is computed in blocks of batch numbers rather
than with one window (which would move the whole history into one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actiflow.operators.blocks import running

HISTORY_COLUMNS = ["batch_id", "processed_batches", "event_count", "cumulative_event_count",
                   "total_revenue", "avg_spend", "avg_rating", "discounted_orders",
                   "high_value_orders", "at_risk_count"]


def kpi_history(kpi: DataFrame, batches: int = 0, events: int = 0) -> DataFrame:
    """Per-batch KPI rows (one per non-empty batch) with ordinal and running total, counted on
    from ``batches`` and ``events`` of the batches before."""
    scanned = running(kpi, "batch_id", {"cumulative_event_count": "event_count"}, "processed_batches")
    if batches or events:
        scanned = scanned.withColumn("processed_batches", F.col("processed_batches") + F.lit(batches)).withColumn(
            "cumulative_event_count", F.col("cumulative_event_count") + F.lit(events))
    extra = [c for c in kpi.columns if c not in HISTORY_COLUMNS]
    return scanned.select(*(extra + HISTORY_COLUMNS))


def newest(kpi: DataFrame) -> DataFrame:
    """The newest row of ``kpi_history`` from one aggregate: no history is built for it.
    No row without batches."""
    extra = [c for c in kpi.columns if c not in HISTORY_COLUMNS]
    last = F.max_by(F.struct(*kpi.columns), "batch_id").alias("last")
    totals = kpi.agg(last, F.count(F.lit(1)).alias("processed_batches"),
                     F.sum("event_count").alias("cumulative_event_count"))
    totals = totals.filter("processed_batches > 0")
    return totals.select(*[F.col(c) if c in totals.columns else F.col(f"last.{c}").alias(c)
                           for c in extra + HISTORY_COLUMNS])


def recent(kpi: DataFrame, n: int, batches: int = 0, events: int = 0) -> DataFrame:
    """The newest ``n`` rows of ``kpi_history``, newest first: two totals less what came
    after each row, so that no history is built."""
    rows = kpi.orderBy(F.col("batch_id").desc()).limit(n)
    totals = kpi.agg(F.count(F.lit(1)).alias("batches"), F.sum("event_count").alias("events"))
    newer = Window.orderBy(F.col("batch_id").desc()).rowsBetween(Window.unboundedPreceding, -1)  # over n rows
    extra = [c for c in kpi.columns if c not in HISTORY_COLUMNS]
    return (rows.withColumn("processed_batches", totals.select("batches").scalar() + F.lit(batches)
                            - F.row_number().over(Window.orderBy(F.col("batch_id").desc())) + 1)
            .withColumn("cumulative_event_count", totals.select("events").scalar() + F.lit(events)
                        - F.coalesce(F.sum("event_count").over(newer), F.lit(0)))
            .select(*(extra + HISTORY_COLUMNS)).orderBy(F.col("batch_id").desc()))
