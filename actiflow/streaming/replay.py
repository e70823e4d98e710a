"""Replay a table of events into a JSON-lines folder that a file stream reads.

The folder is written by one distributed Spark job, partitioned by the
producer's batch number; task commit makes each file appear whole (the
reference wrote files in place, so a reader could see half a file).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiflow.functions.codecs import event_time_text
from actiflow.schemas import EVENT_FIELDS


def write_event_files(events: DataFrame, path: str, batch_col: str = "batch_id",
                      num_files: int | None = None) -> None:
    """JSON lines with the 13 event fields plus the producer batch number.

    Range-partitioned on (batch, id): each file holds a contiguous run of
    batches, and a batch with a third of all rows is still split over files.
    """
    cols = []
    for name in EVENT_FIELDS:
        dtype = events.schema[name].dataType
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            cols.append(event_time_text(name).alias(name))
        else:
            cols.append(F.col(name))
    n = num_files or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (events.select(*cols, F.col(batch_col).cast("long").alias(batch_col))
     .repartitionByRange(n, batch_col, "event_id")
     .write.mode("errorifexists")
     .option("ignoreNullFields", "false")
     .json(path))


BATCH_FIELD = T.StructField("batch_id", T.LongType(), True)
