"""Orderings, rankings and top-k.

Full orderings are range sorts (distributed); top-k uses ``orderBy().limit()``,
which Spark plans as ``TakeOrderedAndProject``: each task keeps its own k best
rows and only k rows per task reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actiflow.functions import rules
from actiflow.schemas import AT_RISK_CLASSIC_COLUMNS, AT_RISK_COLUMNS

# The reference ranks at-risk rows by days desc, rating asc only; ties were
# arbitrary. The extra keys make the order total (and so repeatable).
def risk_order(with_event_id: bool = True) -> list:
    order = [F.col("days_since_last_purchase").desc_nulls_last(),
             F.col("average_rating").asc_nulls_first(),
             F.col("customer_id").asc_nulls_first(),
             F.col("event_time").asc_nulls_first()]
    return order + ([F.col("event_id").asc_nulls_first()] if with_event_id else [])


def event_order() -> list:
    return [F.col("event_time").asc_nulls_first(), F.col("event_id").asc_nulls_first()]


def ordered_events(events: DataFrame) -> DataFrame:
    return events.orderBy(*event_order())


def at_risk_ranked(enriched: DataFrame) -> DataFrame:
    return (enriched.filter(F.col("is_at_risk"))
            .orderBy(*risk_order())
            .select(*AT_RISK_COLUMNS))


def top_at_risk(enriched: DataFrame, n: int = 10) -> DataFrame:
    """Report panel: the n highest-ranked at-risk rows (the limit is the feature)."""
    return (enriched.filter(F.col("is_at_risk"))
            .orderBy(*risk_order()).limit(n)
            .select(*AT_RISK_COLUMNS))


def at_risk_classic(events: DataFrame, rule: rules.RiskRule = rules.RiskRule()) -> DataFrame:
    return events.filter(rules.at_risk_classic(rule=rule)).select(*AT_RISK_CLASSIC_COLUMNS)


def latest_events(events: DataFrame, n: int = 10, batch_col: str = "batch_id") -> DataFrame:
    """First n rows (by time, id) of the newest batch, in one pass.

    Ordered by batch descending first, the newest batch's rows come first, so
    the newest batch's first n rows are exactly the rows of one top-n that
    carry the top row's batch id. The newest id is then found over at most n
    rows (a bounded single-task window), not by a second pass over the events.
    """
    top = events.orderBy(F.col(batch_col).desc_nulls_last(), *event_order()).limit(n)
    newest = F.max(batch_col).over(Window.partitionBy())
    return (top.withColumn("_newest", newest)
            .filter(F.col(batch_col) == F.col("_newest"))
            .drop("_newest")
            .orderBy(*event_order()))


def recent_kpis(history: DataFrame, n: int = 8) -> DataFrame:
    """The n newest KPI rows, newest first."""
    return history.orderBy(F.col("batch_id").desc()).limit(n)


def latest_kpi(history: DataFrame) -> DataFrame:
    return recent_kpis(history, 1)
