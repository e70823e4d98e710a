"""End-to-end streaming jobs (the reference's two entry points, as functions).

``run_event_job``: events (JSON files or Kafka) -> decode -> enrich ->
micro-batch fan-out into the result store -> stop rule -> report tables.

``run_segment_job``: CSV messages (Kafka or files) -> age groups -> two
stateful update-mode rollups started together -> latest version per group;
each update batch can also be appended to JDBC tables (one table per grain).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actiflow.functions import exact
from actiflow.operators.enrich import enrich
from actiflow.operators.windows import dedup_whole_rows
from actiflow.plans.reports import reports_from_store, save_reports
from actiflow.sinks.external import jdbc_batch_sink
from actiflow.sinks.store import ResultStore
from actiflow.sources.events import SourceSpec, read_events
from actiflow.streaming.control import run_until
from actiflow.streaming.processor import start_event_query
from actiflow.streaming.segments import SEGMENT_KEYS, current_segments, start_segment_query


@dataclass
class RunLimits:
    available_now: bool = False        # bounded run over what is there, then stop
    trigger_seconds: float = 5.0
    max_batches: int | None = None     # non-empty micro-batches; None: no end
    idle_seconds: float | None = None


def run_event_job(spark: SparkSession, source: SourceSpec, store_root: str, checkpoint: str,
                  limits: RunLimits = RunLimits(), dedup_delay: str | None = None,
                  late_after: str | None = None) -> dict[str, DataFrame]:
    """``dedup_delay`` (e.g. "1 hour"): drop events whose id came before within that delay.
    ``late_after``: keep events that much older than the newest one before apart, in ``late``."""
    store = ResultStore(spark, store_root)
    stream = enrich(read_events(spark, replace(source, keep_raw=True), streaming=True))
    if dedup_delay:
        stream = dedup_whole_rows(stream, dedup_delay)
    query = start_event_query(stream, store, checkpoint, late_after=late_after,
                              trigger_seconds=limits.trigger_seconds, available_now=limits.available_now)
    if limits.available_now:
        query.awaitTermination()
    else:
        run_until(query, limits.max_batches, limits.idle_seconds)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    tables = reports_from_store(store)
    save_reports(store, tables)
    return tables


def run_segment_job(spark: SparkSession, source: SourceSpec, store_root: str,
                    checkpoint_root: str, limits: RunLimits = RunLimits(),
                    jdbc_url: str | None = None, jdbc_properties: dict | None = None
                    ) -> dict[str, DataFrame]:
    """JDBC rows carry their epoch: an appended table keeps every state of a segment, and a
    replayed epoch can only append identical rows, so readers that take the newest state per
    segment (highest epoch) are unaffected."""
    store = ResultStore(spark, store_root)
    messages = read_events(spark, source, streaming=True)
    sinks = {t: jdbc_batch_sink(jdbc_url, t, jdbc_properties or {}) for t in SEGMENT_KEYS} if jdbc_url else {}

    def also(table: str, rows: DataFrame, epoch: int) -> None:
        values = rows.select(*SEGMENT_KEYS[table],
                             exact.rounded_mean("spend_sum", "spend_n").alias("avg_total_spend"),
                             F.col("items_sum").alias("total_items_purchased"),
                             F.lit(epoch).cast("long").alias("epoch"))
        sinks[table](values, epoch)

    query = start_segment_query(messages, store, f"{checkpoint_root}/segments",
                                available_now=limits.available_now, trigger_seconds=limits.trigger_seconds,
                                also=also if sinks else None)
    if limits.available_now:
        query.awaitTermination()
    else:
        run_until(query, limits.max_batches, limits.idle_seconds)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return {t: current_segments(store, t) for t in SEGMENT_KEYS}
