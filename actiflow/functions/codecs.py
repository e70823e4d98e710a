"""Column codecs: bytes/text <-> typed event columns, run inside Spark plans.

Decoding is permissive like the reference: undecodable text gives an all-null
row, a single bad field gives a null in that field only. Rows are never
dropped here; ``split_valid`` separates them afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiflow.schemas import CSV_MESSAGE_DDL, CSV_MESSAGE_FIELDS, EVENT_FIELDS, EVENT_KEYS, EVENT_SCHEMA

# Fixed value: event times travel as ISO-8601 UTC text with a trailing 'Z'; fractions of a
# second appear only where there are any.
EVENT_TIME_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def event_time_text(col="event_time") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.regexp_replace(F.date_format(c, EVENT_TIME_TEXT), r"\.?0+$", ""), F.lit("Z"))


def _text_fields(df: DataFrame, fields: list[str]) -> list[Column]:
    out = []
    for name in fields:
        dtype = df.schema[name].dataType
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            out.append(event_time_text(name).alias(name))
        else:
            out.append(F.col(name))
    return out


def json_text(df: DataFrame, fields: list[str] | None = None) -> Column:
    """One JSON object per row; null fields are written (``"x":null``)."""
    return F.to_json(F.struct(*_text_fields(df, fields or EVENT_FIELDS)),
                     {"ignoreNullFields": "false"})


def csv_text(df: DataFrame, fields: list[str] | None = None) -> Column:
    """One CSV line per row (no header); null fields are empty."""
    return F.to_csv(F.struct(*_text_fields(df, fields or CSV_MESSAGE_FIELDS)))


def encode_json(df: DataFrame, key: str | None = None,
                fields: list[str] | None = None) -> DataFrame:
    """Events -> Kafka-shaped (key, value) binary frame with JSON values."""
    key_col = F.col(key).cast("string").cast("binary") if key else F.lit(None).cast("binary")
    return df.select(key_col.alias("key"), json_text(df, fields).cast("binary").alias("value"))


def encode_csv(df: DataFrame, key: str | None = None,
               fields: list[str] | None = None) -> DataFrame:
    key_col = F.col(key).cast("string").cast("binary") if key else F.lit(None).cast("binary")
    return df.select(key_col.alias("key"), csv_text(df, fields).cast("binary").alias("value"))


def decode_json(df: DataFrame, value_col: str = "value", schema: T.StructType = EVENT_SCHEMA,
                keep: list[str] | None = None) -> DataFrame:
    """Binary or text JSON -> flat event columns (plus the ``keep`` columns)."""
    text = F.col(value_col).cast("string")
    parsed = df.select(*(keep or []), F.from_json(text, schema).alias("_event"))
    return parsed.select(*(keep or []), *[F.col(f"_event.{f.name}").alias(f.name)
                                          for f in schema.fields])


def decode_csv(df: DataFrame, value_col: str = "value", ddl: str = CSV_MESSAGE_DDL,
               keep: list[str] | None = None) -> DataFrame:
    """Binary or text CSV line -> flat columns of the DDL schema.

    Python-style ``True``/``False`` are read as booleans.
    """
    text = F.col(value_col).cast("string")
    parsed = df.select(*(keep or []), F.from_csv(text, ddl).alias("_msg"))
    return parsed.select(*(keep or []), "_msg.*")


def reject_reason(keys: list[str] | None = None) -> Column:
    """Name of the first missing key, or null for a valid row."""
    expr = None
    for k in (keys or EVENT_KEYS):
        cond = F.col(k).isNull()
        expr = F.when(cond, F.lit(f"missing {k}")) if expr is None else expr.when(cond, F.lit(f"missing {k}"))
    return expr.otherwise(F.lit(None).cast("string"))


def with_validity(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason(keys))


def split_valid(df: DataFrame, keys: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reject_reason``); together they are all rows."""
    keys = keys or EVENT_KEYS
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return df.filter(ok), with_validity(df.filter(~ok), keys)
