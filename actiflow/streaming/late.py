"""Events behind the watermark: split off, stored and counted per trigger.

Spark's own watermark drops late rows unseen. Here the watermark of an epoch is the newest
event time of all earlier epochs of its generation less the allowed lateness, taken from the
stored trigger rows. It does not depend on the epoch itself, so a replayed epoch splits its
rows the same way, also in another process. Every row read is kept, late or rejected.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiflow.sinks.store import VERSION_FIELDS, ResultStore

TRIGGER_FIELDS = [T.StructField("rows_read", T.LongType()), T.StructField("kept", T.LongType()),
                  T.StructField("late", T.LongType()), T.StructField("rejected", T.LongType()),
                  T.StructField("watermark", T.TimestampNTZType()),
                  T.StructField("newest_event_time", T.TimestampNTZType())]
TRIGGER_SCHEMA = T.StructType(TRIGGER_FIELDS + VERSION_FIELDS)


class Lateness:
    """Watermarks of one generation. ``allowed``: an interval ("1 hour"); None: nothing is late."""

    def __init__(self, store: ResultStore, generation: str, allowed: str | None):
        self.store, self.generation = store, generation
        self.allowed = allowed
        self._newest: dict[int, dt.datetime | None] = {}  # of the last epochs of this process

    def newest_before(self, epoch: int) -> dt.datetime | None:
        """Newest event time of all earlier epochs. Trigger rows carry it on, so the one
        before is enough; it is read when this process did not write it."""
        earlier = [e for e in self._newest if e < epoch]
        if earlier:
            return self._newest[max(earlier)]
        rows = triggers(self.store).filter((F.col("generation") == self.generation) & (F.col("epoch") < epoch))
        return rows.agg(F.max("newest_event_time")).first()[0]

    def watermark(self, epoch: int) -> Column:
        newest = self.newest_before(epoch) if self.allowed is not None else None
        if newest is None:
            return F.lit(None).cast("timestamp_ntz")
        return F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.allowed}")

    def counted(self, checked: DataFrame, is_valid: Column, is_late: Column, epoch: int) -> Row:
        """The trigger row of an epoch: counts that add up to the rows read."""
        count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
        return checked.agg(F.count(F.lit(1)).alias("rows_read"), count(is_valid & ~is_late).alias("kept"),
                           count(is_valid & is_late).alias("late"), count(~is_valid).alias("rejected"),
                           F.max(self.watermark(epoch)).alias("watermark"),
                           F.max(F.when(is_valid, F.col("event_time").cast("timestamp_ntz")))
                           .alias("newest_event_time")).first()

    def record(self, trigger: Row, epoch: int) -> None:
        """Store a trigger row, the last write of its epoch; it carries the newest time on."""
        times = [t for t in (self.newest_before(epoch), trigger["newest_event_time"]) if t is not None]
        newest = max(times, default=None)
        out = self.store.spark.createDataFrame([(*trigger[:-1], newest)], T.StructType(TRIGGER_FIELDS))
        self.store.write_version(out.coalesce(1), "triggers", self.generation, epoch)
        self._newest = {e: t for e, t in self._newest.items() if e == epoch - 1} | {epoch: newest}


def triggers(store: ResultStore) -> DataFrame:
    """One row per stored micro-batch."""
    return store.read("triggers", TRIGGER_SCHEMA)
