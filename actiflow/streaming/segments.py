"""Stateful segment rollups in update mode (the older pipeline, made to work).

Both grains come from one query: one read of the source, one aggregate over grouping sets,
one state store. (The reference started a query per grain, awaited the first before it
started the second, so the second never ran, and sent both grains to one table, which fails
on the second schema.) Update rows hold mergeable state (exact sums and counts); the writer
puts each grain's rows of an epoch into the partition of their version. A segment's value is
the newest state of every generation, merged: a query that starts on a new checkpoint counts
from nothing again, and what earlier ones counted stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from actiflow.operators import summaries
from actiflow.operators.enrich import with_age_group
from actiflow.operators.summaries import SEGMENT_KEYS
from actiflow.operators.upsert import latest_per_key
from actiflow.schemas import EVENT_SCHEMA
from actiflow.sinks.store import VERSION_FIELDS, ResultStore, compact, compacted_rows

# State partitions of the segment rollups. The group space is small and bounded
# (tiers x age groups x cities), and partial aggregation shrinks each trigger's
# input before the shuffle, so a few state partitions suffice; more only add
# per-trigger task and state-commit overhead. Pinned in the checkpoint at the
# first run.
STATE_PARTITIONS = 8

_FINEST = SEGMENT_KEYS["customer_segments"]
#: Bits of GROUPING_ID: a key that a grain leaves out is 1, the first key is the highest bit.
GRAIN_IDS = {table: sum(1 << (len(_FINEST) - 1 - i) for i, k in enumerate(_FINEST) if k not in keys)
             for table, keys in SEGMENT_KEYS.items()}


def segment_states(events: DataFrame) -> DataFrame:
    """Mergeable states of both grains, told apart by ``grain``: one aggregate, batch or stream."""
    aged = with_age_group(events)
    return (aged.groupingSets([[F.col(k) for k in keys] for keys in SEGMENT_KEYS.values()], *_FINEST)
            .agg(F.grouping_id().cast("int").alias("grain"), *summaries.segment_state()))


def of_grain(states: DataFrame, table: str) -> DataFrame:
    keys = SEGMENT_KEYS[table]
    return states.filter(F.col("grain") == GRAIN_IDS[table]).drop("grain", *[k for k in _FINEST if k not in keys])


class UpdateRowsWriter:
    """``foreachBatch`` callback: the update rows of an epoch go to one table per grain, and,
    when given, to ``also(table, rows, epoch)``."""

    def __init__(self, store: ResultStore, checkpoint: str | None = None,
                 also: Callable[[str, DataFrame, int], None] | None = None):
        self.store, self.checkpoint, self.also = store, checkpoint, also
        self._generation: str | None = None

    def __call__(self, df: DataFrame, epoch_id: int) -> None:
        if self._generation is None:  # the checkpoint exists by the first batch
            self._generation = self.store.generation(self.checkpoint)
        batch = df.persist(StorageLevel.MEMORY_AND_DISK)  # the stateful step runs once
        try:
            if batch.isEmpty():
                return
            for table in SEGMENT_KEYS:
                rows = of_grain(batch, table)
                self.store.write_version(rows, table + "_updates", self._generation, epoch_id)
                if self.also is not None:
                    self.also(table, rows, int(epoch_id))
        finally:
            batch.unpersist()


def start_with_partitions(writer: DataStreamWriter, spark: SparkSession,
                          partitions: int | None) -> StreamingQuery:
    """Start a query whose stateful shuffle uses ``partitions`` partitions.

    The stream clones the session's settings when it starts, so the caller's
    session is restored right after."""
    if partitions is None:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


def start_segment_query(events_stream: DataFrame, store: ResultStore, checkpoint: str,
                        available_now: bool = False, trigger_seconds: float = 5.0,
                        state_partitions: int | None = STATE_PARTITIONS,
                        also: Callable[[str, DataFrame, int], None] | None = None) -> StreamingQuery:
    w = (segment_states(events_stream).writeStream.outputMode("update")
         .foreachBatch(UpdateRowsWriter(store, checkpoint, also))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return start_with_partitions(w, events_stream.sparkSession, state_partitions)


def update_schema(store: ResultStore, table: str) -> T.StructType:
    """Schema of a table of update rows; a table never written reads as empty."""
    states = of_grain(segment_states(store.spark.createDataFrame([], EVENT_SCHEMA)), table)
    return T.StructType(states.schema.fields + VERSION_FIELDS)


def updates(store: ResultStore, table: str) -> DataFrame:
    """Stored update rows: the newest compaction and the versions after it."""
    return compacted_rows(store, table + "_updates", update_schema(store, table))


def newest_states(rows: DataFrame, table: str) -> DataFrame:
    """The newest state of every segment in every generation (columns of ``rows``)."""
    keys = ["generation", *SEGMENT_KEYS[table]]
    rows = rows.withColumn("_epoch", F.col("epoch"))
    return latest_per_key(rows, keys, "_epoch")


def current_segments(store: ResultStore, table: str, decimals: int | None = 2) -> DataFrame:
    return summaries.merge_segment_state(newest_states(updates(store, table), table), SEGMENT_KEYS[table], decimals)


def compact_segments(store: ResultStore, table: str, keep_epochs: int = 100) -> None:
    """Keep only the newest state of every segment among all but the newest epochs."""
    compact(store, table + "_updates", update_schema(store, table), keep_epochs,
            lambda rows: newest_states(rows, table))
