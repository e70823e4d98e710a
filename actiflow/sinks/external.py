"""External sinks: JDBC tables and Kafka topics.

Both are thin DataFrameWriter configurations. Credentials and URLs are passed
by the caller, never stored in code. The Kafka connector jar must be supplied
at submit time (``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:<ver>``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql.streaming import DataStreamWriter

from actiflow.functions import codecs


def jdbc_writer(url: str, table: str, properties: dict[str, str],
                mode: str = "append") -> Callable[[DataFrame], None]:
    """Batch writer for one JDBC table (rows are appended by default)."""

    def write(df: DataFrame) -> None:
        df.write.jdbc(url=url, table=table, mode=mode, properties=properties)

    return write


def jdbc_batch_sink(url: str, table: str, properties: dict[str, str],
                    mode: str = "append") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback (two arguments: frame and epoch id).

    Appending update-mode output keeps every version of a group; readers take
    the latest per key (see ``operators.upsert.latest_per_key``).
    """
    write = jdbc_writer(url, table, properties, mode)

    def sink(df: DataFrame, epoch_id: int) -> None:
        if not df.isEmpty():
            write(df)

    return sink


def _frame(df: DataFrame, value: str, key: str | None, fields: list[str] | None) -> DataFrame:
    if value == "json":
        return codecs.encode_json(df, key, fields)
    return codecs.encode_csv(df, key, fields)


def kafka_batch_writer(df: DataFrame, servers: str, topic: str, value: str = "json",
                       key: str | None = None, fields: list[str] | None = None) -> DataFrameWriter:
    """Publish rows as JSON (or CSV) values to a topic (batch write)."""
    frame = _frame(df, value, key, fields)
    return (frame.write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic))


def kafka_stream_writer(df: DataFrame, servers: str, topic: str, checkpoint: str,
                        value: str = "json", key: str | None = None,
                        fields: list[str] | None = None) -> DataStreamWriter:
    frame = _frame(df, value, key, fields)
    return (frame.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint))
