"""Event-time windows and de-duplication (additions beyond the reference).

The reference's KPIs depend on how arrival timing cut micro-batches; event-time
windows give the same answer however the data arrives. The streaming variants
carry a watermark so state stays bounded; the batch variants are their twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiflow.functions import exact


def with_watermark(events: DataFrame, time_col: str, delay: str) -> DataFrame:
    """Watermarks need a zoned TIMESTAMP; a TIMESTAMP_NTZ column is cast first
    (the session zone is UTC, so the wall clock is unchanged)."""
    if isinstance(events.schema[time_col].dataType, T.TimestampNTZType):
        events = events.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return events.withWatermark(time_col, delay)


def window_kpis(events: DataFrame, time_col: str = "ts", key_col: str = "event_type",
                value_col: str = "value", width: str = "1 day", slide: str | None = None,
                watermark: str | None = None) -> DataFrame:
    """Count and value total per (tumbling or sliding) event-time window and key."""
    df = with_watermark(events, time_col, watermark) if watermark else events
    win = F.window(time_col, width, slide) if slide else F.window(time_col, width)
    return (df.groupBy(win.alias("w"), F.col(key_col))
            .agg(F.count(F.lit(1)).alias("event_count"),
                 exact.rounded(exact.total(value_col)).alias("total_value"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    key_col, "event_count", "total_value"))


def dedup_events(events: DataFrame, key: str = "event_id", time_col: str | None = None,
                 watermark: str | None = None) -> DataFrame:
    """Drop repeated deliveries of the same event id.

    Batch: ``dropDuplicates`` (a hash aggregate on the id, partial before the
    shuffle). Stream: ``dropDuplicatesWithinWatermark``, so state for an id is
    dropped once the watermark passes it.
    """
    if events.isStreaming:
        if not (watermark and time_col):
            raise ValueError("de-duplication of a stream needs time_col and a watermark: "
                             "without them its state grows without bound")
        return with_watermark(events, time_col, watermark).dropDuplicatesWithinWatermark([key])
    return events.dropDuplicates([key])


def dedup_whole_rows(events: DataFrame, delay: str, id_col: str = "event_id",
                     time_col: str = "event_time") -> DataFrame:
    """Drop repeated deliveries of an event within ``delay``; rows without an id or a time are
    rejects, not duplicates of one another, and all stay.

    One stateful step for both, so that the source is read once: a broken row gets a key that
    no other row has and no event time, so its state goes with the next watermark.
    """
    whole = F.col(id_col).isNotNull() & F.col(time_col).isNotNull()
    keyed = events.withColumn("_key", F.when(whole, F.concat(F.lit("id:"), F.col(id_col)))
                              .otherwise(F.concat(F.lit("row:"), F.uuid())))
    kept = dedup_events(keyed, "_key", time_col, delay)
    return kept.withColumn(time_col, F.col(time_col).cast(events.schema[time_col].dataType)).drop("_key")


def session_kpis(events: DataFrame, time_col: str = "ts", key_col: str = "user_id", value_col: str = "value",
                 gap_seconds: int = 1800) -> DataFrame:
    """Count and value total per session: a run of a key's events of which each comes at most
    ``gap_seconds`` after the one before. A session ends one gap after its last event.

    Events of a key within one cell of ``gap_seconds`` always share a session, so they are
    summed first (partial aggregation before the shuffle): a key with a third of all events is
    left with one row per cell, whatever its number of events. Sessions are runs of cells.
    Events without a time belong to no session; a null key is a key.
    """
    gap = gap_seconds * 1_000_000
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    cells = (events.filter(F.col(time_col).isNotNull())
             .groupBy(F.col(key_col), (micros - F.pmod(micros, F.lit(gap))).alias("_cell"))
             .agg(F.min(micros).alias("_first"), F.max(micros).alias("_last"), F.count(F.lit(1)).alias("_n"),
                  exact.total(value_col).alias("_sum")))
    ordered = Window.partitionBy(key_col).orderBy("_cell")
    opens = F.col("_first") - F.lag("_last").over(ordered) > F.lit(gap)
    numbered = (cells.withColumn("_opens", F.coalesce(opens, F.lit(True)).cast("long"))
                .withColumn("_session", F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0))))
    time_type = events.schema[time_col].dataType
    return (numbered.groupBy(key_col, "_session")
            .agg(F.timestamp_micros(F.min("_first")).cast(time_type).alias("session_start"),
                 F.timestamp_micros(F.max("_last") + F.lit(gap)).cast(time_type).alias("session_end"),
                 F.sum("_n").cast("long").alias("event_count"),
                 exact.rounded(exact.merged("_sum")).alias("total_value"))
            .drop("_session"))


def session_kpis_stream(events: DataFrame, watermark: str, time_col: str = "ts", key_col: str = "user_id",
                        value_col: str = "value", gap_seconds: int = 1800) -> DataFrame:
    """The streaming twin of ``session_kpis``: Spark's session state, closed by the watermark."""
    timed = with_watermark(events, time_col, watermark)
    session = F.session_window(time_col, f"{gap_seconds} seconds")
    return (timed.groupBy(session.alias("w"), F.col(key_col))
            .agg(F.count(F.lit(1)).alias("event_count"), exact.rounded(exact.total(value_col)).alias("total_value"))
            .select(key_col, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
                    "event_count", "total_value"))
