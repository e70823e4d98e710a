"""Report tables (data only; rendering a page is left to the viewer).

Each report is a small DataFrame computed from stored or batch results:
cards (latest KPI), bar series (first 8 groups, width relative to the largest
bar), panels (top-k tables) and summary facts. The inputs are already reduced
(KPI rows, per-city rows), so the windows here run over at most 8 rows per
series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actiflow.functions import exact
from actiflow.operators.summaries import count_true

# Card labels, bar count, minimum bar width (percent).
CARD_LABELS = ["Processed Batches", "Total Events", "Latest Revenue", "At-Risk Customers"]
BAR_ROWS = 8
PANEL_ROWS = 10
MIN_BAR_WIDTH = 6.0


def newest_batch(events: DataFrame) -> DataFrame:
    """The events of the newest batch; its number is a scalar subquery."""
    return events.filter(F.col("batch_id") == events.agg(F.max("batch_id")).scalar())


def latest_row(history: DataFrame, order_col: str = "batch_id") -> DataFrame:
    """Exactly one row: the newest history row, or all nulls when empty."""
    cols = [c for c in history.columns]
    return (history.agg(F.max_by(F.struct(*cols), order_col).alias("r"))
            .select(*[F.col(f"r.{c}").alias(c) for c in cols]))


def report_cards(history: DataFrame) -> DataFrame:
    """Four (card, value) rows; zero when there is no history yet."""
    last = latest_row(history)
    as_int = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").cast("string")
    revenue = F.format_string("%.2f", F.coalesce(F.col("total_revenue"), F.lit(0.0)))
    pairs = [(CARD_LABELS[0], as_int("processed_batches")),
             (CARD_LABELS[1], as_int("cumulative_event_count")),
             (CARD_LABELS[2], revenue),
             (CARD_LABELS[3], as_int("at_risk_count"))]
    return last.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(label).alias("card"), value.alias("value"))
        for i, (label, value) in enumerate(pairs, 1)])).alias("c")).select("c.*")


def bar_series(df: DataFrame, chart: str, label_col: str, value_col: str,
               integral: bool) -> DataFrame:
    first = df.orderBy(label_col).limit(BAR_ROWS)
    top = Window.partitionBy("chart")
    text = (F.col("value").cast("long").cast("string") if integral
            else F.format_string("%.2f", F.col("value")))
    return (first.select(F.lit(chart).alias("chart"), F.col(label_col).cast("string").alias("label"),
                         F.col(value_col).cast("double").alias("value"))
            .withColumn("value_text", text)
            .withColumn("width", F.round(F.greatest(
                F.lit(MIN_BAR_WIDTH),
                F.col("value") / F.greatest(F.max("value").over(top), F.lit(1.0)) * F.lit(100.0)), 1)))


def report_bars(city_summary: DataFrame, membership_summary: DataFrame) -> DataFrame:
    return (bar_series(city_summary, "avg_spend_by_city", "city", "avg_total_spend", False)
            .unionByName(bar_series(membership_summary, "events_by_membership",
                                    "membership_type", "event_count", True)))


# Metric names of the summary and where their values come from.
SUMMARY_FACTS = [("processed_batches", "processed_batches"), ("total_events", "cumulative_event_count"),
                 ("latest_revenue", "total_revenue"), ("latest_avg_spend", "avg_spend"),
                 ("latest_at_risk", "at_risk_count")]
SUMMARY_COUNTS = ["cities", "membership_groups", "at_risk_records"]


def _facts(row: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value"))
        for m, c in columns])).alias("f")).select("f.*")


def report_summary(history: DataFrame, city_summary: DataFrame,
                   membership_summary: DataFrame, at_risk: DataFrame) -> DataFrame:
    """(metric, value) facts of the latest batch and the result tables."""
    out = _facts(latest_row(history), SUMMARY_FACTS)
    for name, t in zip(SUMMARY_COUNTS, (city_summary, membership_summary, at_risk)):
        out = out.unionByName(t.agg(F.count(F.lit(1)).cast("double").alias("value"))
                              .select(F.lit(name).alias("metric"), "value"))
    return out


def report_summary_of(enriched: DataFrame) -> DataFrame:
    """The same facts from one pass over the events: states per (batch, city, tier), then per
    batch, then the newest batch and the totals."""
    groups = enriched.groupBy("batch_id", "city", "membership_type").agg(
        F.count(F.lit(1)).alias("n"), exact.total("total_spend").alias("spend_sum"),
        exact.count("total_spend").alias("spend_n"), count_true("is_at_risk").alias("at_risk_count"))
    distinct = lambda c: F.count_distinct(c) + F.max(F.col(c).isNull().cast("long"))
    batches = groups.groupBy("batch_id").agg(
        F.sum("n").alias("event_count"), exact.merged("spend_sum").alias("spend_sum"),
        F.sum("spend_n").alias("spend_n"), F.sum("at_risk_count").alias("at_risk_count"),
        distinct("city").alias("cities"), distinct("membership_type").alias("membership_groups"))
    newest = ["spend_sum", "spend_n", "at_risk_count", "cities", "membership_groups"]
    row = batches.agg(F.max_by(F.struct(*newest), "batch_id").alias("r"),
                      F.nullif(F.count(F.lit(1)), F.lit(0)).alias("processed_batches"),
                      F.sum("event_count").alias("cumulative_event_count")).select("r.*", "processed_batches",
                                                                                   "cumulative_event_count")
    row = row.select(
        "processed_batches", "cumulative_event_count", exact.rounded("spend_sum").alias("total_revenue"),
        exact.rounded_mean("spend_sum", "spend_n").alias("avg_spend"), "at_risk_count",
        *[F.coalesce(c, F.lit(0)).alias(m) for c, m in
          (("cities", "cities"), ("membership_groups", "membership_groups"), ("at_risk_count", "at_risk_records"))])
    return _facts(row, SUMMARY_FACTS + [(m, m) for m in SUMMARY_COUNTS])


def reports_from_store(store) -> dict[str, DataFrame]:
    """Rebuild every report from stored results alone (no stream needed)."""
    from actiflow.operators import ranking
    from actiflow.streaming.processor import latest_snapshots, recent_kpi_view

    history = recent_kpi_view(store, BAR_ROWS)
    latest = latest_snapshots(store)
    city, membership, at_risk = (latest["city_summary"], latest["membership_summary"],
                                 latest["at_risk"])
    return {
        "cards": report_cards(history),
        "bars": report_bars(city, membership),
        "recent_kpis": history,
        "at_risk": at_risk.orderBy(*ranking.risk_order(False)).limit(PANEL_ROWS),
        "latest_events": latest["latest_events"].orderBy(*ranking.event_order()).limit(PANEL_ROWS),
        "membership": membership.limit(PANEL_ROWS),
        "summary": report_summary(history, city, membership, at_risk),
    }


def save_reports(store, tables: dict[str, DataFrame]) -> None:
    """Replace the stored report tables (snapshot writes; each is small)."""
    for name, df in tables.items():
        store.write_snapshot(df, f"reports/{name}")
