"""Micro-batch fan-out: one enriched micro-batch feeds every result table.

The reference collected each micro-batch to the driver five times (uncached)
and appended CSV files. Here the batch is persisted once, every output is a
Spark writer running on executors, and every write replaces partitions keyed
by the version (generation and epoch), so replaying an epoch after a
failure rewrites the same files instead of duplicating rows.

Stored are facts only, each table partitioned by version: the generation (one per checkpoint)
and the epoch (one new partition per micro-batch, bounded by the number of triggers, never by
a data value):
  events       valid enriched events (with the producer batch id)
  rejects      rows with a missing key, with ``reject_reason`` and, when the source
               keeps them, the raw record and its position
  late         valid events behind the watermark (only with a lateness limit), which the other
               tables do not hold
  kpi_parts    mergeable KPI partials per producer batch
  triggers     rows read, kept, late and rejected, and the newest event time (written last)
The reference's "latest" snapshot files (city, membership, at-risk) are views
over the newest version's events partition (partition-pruned), and the KPI table
is the merge of all partials per producer batch, so a batch whose events
arrive in several micro-batches is still counted whole.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from actiflow.functions import exact
from actiflow.functions.codecs import with_validity
from actiflow.operators import history, summaries
from actiflow.operators.blocks import running
from actiflow.operators.enrich import enrich
from actiflow.schemas import AT_RISK_COLUMNS, EVENT_SCHEMA
from actiflow.sinks.store import (VERSION, VERSION_FIELDS, ResultStore, compact, compacted_rows, compaction_note,
                                  tail_rows, version)
from actiflow.sources.events import RAW_COLUMNS
from actiflow.streaming.late import Lateness


class EventBatchWriter:
    """``foreachBatch`` callback for enriched events.

    ``batch_col``: producer batch number carried by the events (a field of the
    file replay). When absent, the epoch id is the batch. ``checkpoint`` is the query's: its
    generation keeps epochs of different checkpoints apart. ``late_after`` (e.g. "1 hour"):
    events so much older than the newest one of earlier epochs go to ``late``.
    """

    def __init__(self, store: ResultStore, batch_col: str = "batch_id", checkpoint: str | None = None,
                 late_after: str | None = None):
        self.store = store
        self.batch_col = batch_col
        self.checkpoint = checkpoint
        self.late_after = late_after
        self._lateness: Lateness | None = None

    @property
    def lateness(self) -> Lateness:
        if self._lateness is None:  # the checkpoint exists by the first batch
            self._lateness = Lateness(self.store, self.store.generation(self.checkpoint), self.late_after)
        return self._lateness

    def __call__(self, df: DataFrame, epoch_id: int) -> None:
        batch = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._write(batch, int(epoch_id))
        finally:
            batch.unpersist()

    def _write(self, batch: DataFrame, epoch: int) -> None:
        if self.batch_col not in batch.columns:
            batch = batch.withColumn(self.batch_col, F.lit(epoch).cast("long"))
        lateness = self.lateness
        put = lambda df, name: self.store.write_version(df, name, lateness.generation, epoch)
        checked = with_validity(batch)
        is_valid = F.col("reject_reason").isNull()
        watermark = lateness.watermark(epoch)
        behind = F.coalesce(F.col("event_time") < watermark, F.lit(False))
        trigger = lateness.counted(checked, is_valid, behind, epoch)
        if not trigger["rows_read"]:  # empty triggers write nothing
            return
        # Rejects keep the record as it came. The counts of a replayed epoch are the same, so
        # a table without rows needs no write.
        valid = checked.filter(is_valid & ~behind).drop("reject_reason", *RAW_COLUMNS)
        put(valid, "events")
        if trigger["rejected"]:
            put(checked.filter(~is_valid), "rejects")
        if trigger["late"]:
            put(checked.filter(is_valid & behind).drop("reject_reason", *RAW_COLUMNS)
                .withColumn("watermark", watermark), "late")
        put(summaries.kpi_partials(valid, self.batch_col).withColumn("processed_at", F.current_timestamp()),
            "kpi_parts")
        lateness.record(trigger, epoch)


def events_schema(store: ResultStore) -> T.StructType:
    """Declared schema of the stored events (also what a store without events reads as)."""
    empty = enrich(store.spark.createDataFrame([], EVENT_SCHEMA))
    return T.StructType(empty.schema.fields + [T.StructField("batch_id", T.LongType()), *VERSION_FIELDS])


def kpi_schema(store: ResultStore) -> T.StructType:
    empty = store.spark.createDataFrame([], events_schema(store))
    return T.StructType(summaries.kpi_partials(empty).schema.fields
                        + [T.StructField("processed_at", T.TimestampType()), *VERSION_FIELDS])


def kpi_parts(store: ResultStore) -> DataFrame:
    """Stored partials: the newest compaction and the versions after it."""
    return compacted_rows(store, "kpi_parts", kpi_schema(store))


def merged_parts(rows: DataFrame) -> DataFrame:
    """One partial per producer batch (with its newest version)."""
    sums = [exact.merged(c).alias(c) if c.endswith("_sum") else F.sum(c).cast("long").alias(c)
            for c in rows.columns if c not in ("batch_id", "processed_at", *VERSION)]
    merged = rows.groupBy("batch_id").agg(*sums, F.max("processed_at").alias("processed_at"),
                                          F.max(version()).alias("_newest"))
    return merged.select(*[F.col(f"_newest.{c}").alias(c) if c in VERSION else c for c in rows.columns])


def compact_kpis(store: ResultStore, keep_epochs: int = 100) -> None:
    """Merge the partials of all but the newest ``keep_epochs`` epochs into one row per batch,
    with the batch's place and running total; the pointer row keeps the totals.

    Only epochs that can no longer be replayed may be merged; a replay rewrites the newest
    epoch alone, so any ``keep_epochs`` of 1 or more is safe. Views give the same rows
    before and after; the merged versions' own partitions are then read no more.
    """
    def merge(rows: DataFrame) -> DataFrame:
        return running(merged_parts(rows), "batch_id", {"cumulative_event_count": "event_count"}, "processed_batches")

    def totals(rows: DataFrame) -> dict:
        row = rows.agg(F.count(F.lit(1)), F.sum("event_count"), F.max("batch_id")).first()
        return {"batches": row[0], "events": row[1], "last_batch": row[2]}

    compact(store, "kpi_parts", kpi_schema(store), keep_epochs, merge, totals)


def late_events(store: ResultStore) -> DataFrame:
    """Events that came behind the watermark of their epoch, with that watermark."""
    schema = events_schema(store)
    return store.read("late", T.StructType(schema.fields[:-2] + [T.StructField("watermark", T.TimestampNTZType()),
                                                                 *VERSION_FIELDS]))


def stored_events(store: ResultStore) -> DataFrame:
    return store.read("events", events_schema(store))


def kpi_table(store: ResultStore) -> DataFrame:
    """One KPI row per producer batch, merged from the stored partials."""
    return summaries.merge_kpi_partials(kpi_parts(store))


def _tail(store: ResultStore) -> tuple[DataFrame, dict] | None:
    """(partials after the newest compaction, its totals), if all of them belong to batches
    behind the compacted ones, so that saved running totals hold; else None."""
    note = compaction_note(store, "kpi_parts")
    if note.get("last_batch") is None:
        return None
    tail = tail_rows(store, "kpi_parts", kpi_schema(store))
    older = tail.filter(F.col("batch_id").isNull() | (F.col("batch_id") <= F.lit(note["last_batch"])))
    return (tail, note) if older.isEmpty() else None


def kpi_history_view(store: ResultStore, with_processed_at: bool = False) -> DataFrame:
    """KPI history with ordinal and running total, derived from stored rows.

    After a compaction, the rows it holds keep their saved place and running total and only
    the rest is counted, from the saved totals on. A batch of the compaction that got further
    events since is counted again with all others. ``processed_at`` (when the newest part of a
    batch was written) is wall-clock and so left out unless asked for.
    """
    shown = (["processed_at"] if with_processed_at else []) + history.HISTORY_COLUMNS
    found = _tail(store)
    if found is None:
        return history.kpi_history(kpi_table(store)).select(*shown)
    tail, note = found
    saved = T.StructType(kpi_schema(store).fields + [T.StructField("processed_batches", T.LongType()),
                                                     T.StructField("cumulative_event_count", T.LongType())])
    rows = store.read_snapshot("kpi_parts_compacted", saved)
    closed = summaries.finished_kpis(rows, ["processed_batches", "cumulative_event_count", "processed_at"])
    rest = history.kpi_history(summaries.merge_kpi_partials(tail), note["batches"], note["events"])
    return closed.select(*shown).unionByName(rest.select(*shown))


def recent_kpi_view(store: ResultStore, n: int) -> DataFrame:
    """The newest ``n`` rows of the history, newest first. With a compaction and ``n`` batches
    after it, neither the compacted rows nor a running total over them is read."""
    found = _tail(store)
    if found is not None:
        tail, note = found
        if tail.select("batch_id").distinct().limit(n).count() == n:
            return history.recent(summaries.merge_kpi_partials(tail), n, note["batches"], note["events"]) \
                .select(*history.HISTORY_COLUMNS)
    return history.recent(kpi_table(store), n).select(*history.HISTORY_COLUMNS)


def newest_epoch_events(store: ResultStore) -> DataFrame:
    """Events of the newest micro-batch. The newest version is one scalar read
    from the small partials table; filtering by it as literals lets Spark
    prune the events table to one partition (a join would not: dynamic
    pruning needs a selective filter on the other side)."""
    newest = kpi_parts(store).agg(F.max(version()).alias("v")).first()["v"]
    events = stored_events(store)
    if newest is None:
        return events.limit(0)
    return events.filter((F.col("generation") == newest["generation"]) & (F.col("epoch") == newest["epoch"]))


def latest_snapshots(store: ResultStore) -> dict[str, DataFrame]:
    """The reference's per-micro-batch "latest" tables, as views."""
    latest = newest_epoch_events(store)
    return {
        "city_summary": summaries.city_summary(latest),
        "membership_summary": summaries.membership_summary(latest),
        "at_risk": latest.filter(F.col("is_at_risk")).select(*AT_RISK_COLUMNS),
        "latest_events": latest,
    }


def event_query(enriched_stream: DataFrame, writer: EventBatchWriter, checkpoint: str,
                trigger_seconds: float | None = 5.0, available_now: bool = False,
                name: str | None = None) -> DataStreamWriter:
    w = (enriched_stream.writeStream.foreachBatch(writer)
         .outputMode("append")
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    if available_now:
        return w.trigger(availableNow=True)
    if trigger_seconds:
        return w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w


def start_event_query(enriched_stream: DataFrame, store: ResultStore, checkpoint: str,
                      late_after: str | None = None, **kw) -> StreamingQuery:
    writer = EventBatchWriter(store, checkpoint=checkpoint, late_after=late_after)
    return event_query(enriched_stream, writer, checkpoint, **kw).start()
