"""Event enrichment: typed event time plus the two business flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiflow.functions import rules


def parse_event_time(col="event_time"):
    """ISO-8601 text (``...Z``) to a UTC wall-clock timestamp; bad text -> null.

    ``try_to_timestamp`` instead of ``to_timestamp``: with ANSI mode on, the
    latter fails the whole job on one bad value.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c).cast("timestamp_ntz")


def enrich(df: DataFrame, risk: rules.RiskRule = rules.RiskRule(),
           high_value_spend: float = rules.HIGH_VALUE_SPEND) -> DataFrame:
    out = df
    if isinstance(df.schema["event_time"].dataType, T.StringType):
        out = out.withColumn("event_time", parse_event_time("event_time"))
    return (out.withColumn("is_at_risk", rules.at_risk(rule=risk))
            .withColumn("high_value_order", rules.high_value(threshold=high_value_spend)))


def with_age_group(df: DataFrame, unknown_label: str | None = None) -> DataFrame:
    return df.withColumn("age_group", rules.age_group("age", unknown_label))
