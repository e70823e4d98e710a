"""Event sources: one switch, one schema, one downstream plan.

``read_events`` returns flat, typed (not yet enriched) event columns from a
JSON-lines folder or a Kafka topic, as a stream or as a bounded batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiflow.functions import codecs
from actiflow.schemas import CSV_MESSAGE_DDL, EVENT_SCHEMA, SEED_SCHEMA


@dataclass
class SourceSpec:
    kind: str = "files"                  # "files" | "kafka"
    path: str | None = None              # JSON-lines folder (files)
    servers: str | None = None           # Kafka bootstrap servers
    topic: str | None = None
    starting_offsets: str = "latest"     # "earliest" | "latest"
    fail_on_data_loss: bool = False
    max_files_per_trigger: int | None = None
    max_offsets_per_trigger: int | None = None
    value_format: str = "json"           # "json" | "csv" (older CSV messages)
    extra_fields: list[T.StructField] = field(default_factory=list)  # e.g. a partition column
    keep_raw: bool = False               # raw text and position beside the decoded columns

    def schema(self) -> T.StructType:
        return T.StructType(list(EVENT_SCHEMA.fields) + list(self.extra_fields))


# The record as it came, and where from: a file, or topic/partition/offset.
RAW_COLUMNS = ["raw_value", "raw_origin"]


def read_events(spark: SparkSession, spec: SourceSpec, streaming: bool = True) -> DataFrame:
    if spec.kind == "files":
        reader = spark.readStream if streaming else spark.read
        if streaming and spec.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", spec.max_files_per_trigger)
        if spec.keep_raw:
            lines = reader.text(spec.path).filter(F.trim("value") != "")  # readers skip blank lines
            return decode(lines.select(F.col("value").alias("raw_value"),
                                       F.col("_metadata.file_path").alias("raw_origin")), spec)
        if spec.value_format == "csv":   # older pipeline: one CSV message per line
            return codecs.decode_csv(reader.text(spec.path), ddl=CSV_MESSAGE_DDL)
        return reader.schema(spec.schema()).json(spec.path)
    if spec.kind == "kafka":
        return decode_kafka(read_kafka(spark, spec, streaming), spec)
    raise ValueError(f"unknown source kind {spec.kind!r}")


def read_kafka(spark: SparkSession, spec: SourceSpec, streaming: bool = True) -> DataFrame:
    """Kafka-shaped frame (key, value, topic, partition, offset, timestamp, ...)."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = (reader.option("kafka.bootstrap.servers", spec.servers)
              .option("subscribe", spec.topic)
              .option("startingOffsets", spec.starting_offsets)
              .option("failOnDataLoss", str(spec.fail_on_data_loss).lower()))
    if streaming and spec.max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", spec.max_offsets_per_trigger)
    return reader.load()


def decode(frame: DataFrame, spec: SourceSpec) -> DataFrame:
    """Frame with ``raw_value`` and ``raw_origin`` -> event columns, raw ones kept if asked for."""
    keep = RAW_COLUMNS if spec.keep_raw else []
    if spec.value_format == "json":
        return codecs.decode_json(frame, "raw_value", spec.schema(), keep)
    return codecs.decode_csv(frame, "raw_value", CSV_MESSAGE_DDL, keep)


def decode_kafka(frame: DataFrame, spec: SourceSpec | None = None) -> DataFrame:
    """Kafka-shaped frame -> the same event columns as from files."""
    origin = (F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
              if "topic" in frame.columns else F.lit(None).cast("string"))
    return decode(frame.select(F.col("value").cast("string").alias("raw_value"),
                               origin.alias("raw_origin")), spec or SourceSpec(kind="kafka"))


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV seed (a UTF-8 BOM is tolerated); fails when it has no rows."""
    df = (spark.read.schema(SEED_SCHEMA).option("header", True).option("encoding", "UTF-8")
          .csv(path))
    if df.isEmpty():
        raise ValueError(f"no rows in seed file {path}")
    return df
