"""Reports (also from stored results alone), synthesis bounds and determinism."""

from pyspark.sql import functions as F

from actiflow.operators import history, summaries
from actiflow.operators.enrich import enrich
from actiflow.plans import reports
from actiflow.plans.catalog import activity
from actiflow.plans.synth import synth_events, synth_messages
from actiflow.schemas import KPI_SCHEMA
from actiflow.sinks.store import ResultStore
from actiflow.streaming.processor import EventBatchWriter
from conftest import SF_SMALL


def test_cards_default_to_zero_without_history(spark):
    empty = history.kpi_history(spark.createDataFrame([], KPI_SCHEMA).drop("processed_at"))
    cards = {r["card"]: r["value"] for r in reports.report_cards(empty).collect()}
    assert cards == {"Processed Batches": "0", "Total Events": "0", "Latest Revenue": "0.00",
                     "At-Risk Customers": "0"}


def test_missing_table_reads_empty(spark, workdir):
    store = ResultStore(spark, workdir)
    assert store.read("never_written", KPI_SCHEMA).count() == 0


def test_reports_from_store(spark, workdir):
    ev = enrich(activity(spark, SF_SMALL)).drop("o_orderkey")
    store = ResultStore(spark, f"{workdir}/store")
    writer = EventBatchWriter(store)
    writer(ev.filter(F.col("batch_id") < 2), 0)
    writer(ev.filter(F.col("batch_id") >= 2), 1)
    out = reports.reports_from_store(store)
    cards = {r["card"]: r["value"] for r in out["cards"].collect()}
    assert cards["Total Events"] == str(ev.count())
    assert cards["Processed Batches"] == str(ev.select("batch_id").distinct().count())
    # "latest" panels hold the newest micro-batch only
    assert out["latest_events"].count() == 10
    newest_city = out["bars"].filter(F.col("chart") == "avg_spend_by_city").count()
    assert 0 < newest_city <= 8
    widths = [r["width"] for r in out["bars"].collect()]
    assert all(6.0 <= w <= 100.0 for w in widths) and 100.0 in widths
    assert out["summary"].count() == 8


def test_synth_events_within_clamps_and_partition_independent(spark):
    seed = (activity(spark, SF_SMALL).withColumn("row_no", F.col("o_orderkey")))
    idx = spark.range(1, 401).select(F.col("id").alias("i"))
    a = synth_events(seed, idx).orderBy("event_id").collect()
    b = synth_events(seed.repartition(7), idx.repartition(3)).orderBy("event_id").collect()
    assert a == b
    df = synth_events(seed, idx)
    bad = df.filter((F.col("total_spend") < 120) | (F.col("items_purchased") < 1)
                    | (F.col("average_rating") < 2.8) | (F.col("average_rating") > 5.0)
                    | (F.col("days_since_last_purchase") < 1)
                    | (F.col("age") < 18) | (F.col("age") > 70))
    assert bad.count() == 0
    assert df.agg(F.max("batch_no")).first()[0] == 20   # 400 events in batches of 20


def test_synth_messages_ranges(spark):
    df = synth_messages(spark.range(1, 2001).select(F.col("id").alias("i")))
    r = df.agg(F.min("customer_id"), F.max("customer_id"), F.min("age"), F.max("age"),
               F.min("items_purchased"), F.max("items_purchased"),
               F.min("days_since_last_purchase"), F.max("days_since_last_purchase"),
               F.countDistinct("city"), F.countDistinct("membership_type")).first()
    assert 101 <= r[0] and r[1] <= 999 and 18 <= r[2] and r[3] <= 65
    assert 8 <= r[4] and r[5] <= 19 and 12 <= r[6] and r[7] <= 55
    assert r[8] == 6 and r[9] == 3


def test_reports_are_of_the_newest_batch(spark):
    from actiflow.plans.catalog import QUERIES
    ev = enrich(activity(spark, SF_SMALL))
    newest = ev.filter(F.col("batch_id") == ev.agg(F.max("batch_id")).first()[0])
    facts = {r.metric: r.value for r in QUERIES["report_summary"](spark, SF_SMALL).collect()}
    assert facts["at_risk_records"] == newest.filter("is_at_risk").count() == facts["latest_at_risk"]
    assert facts["cities"] == newest.select("city").distinct().count()
    assert facts["total_events"] == ev.count()


def test_large_indices_and_fractions(spark):
    from actiflow.functions import codecs
    from actiflow.operators.enrich import parse_event_time
    seed = activity(spark, SF_SMALL).withColumn("row_no", F.col("o_orderkey"))
    row = synth_events(seed, spark.sql("SELECT 100000000000L AS i")).first()
    assert row.batch_no == 5_000_000_000 and row.event_time.year == 2816
    times = spark.sql("SELECT timestamp_ntz'2024-01-01 10:00:00.75' AS t UNION ALL SELECT timestamp_ntz'2024-01-01 10:00:10'")
    text = times.select("t", codecs.event_time_text("t").alias("s"))
    assert sorted(r.s for r in text.collect()) == ["2024-01-01T10:00:00.75Z", "2024-01-01T10:00:10Z"]
    assert text.filter(parse_event_time("s") != F.col("t")).count() == 0


def test_newest_kpi_is_the_last_history_row(spark):
    kpi = summaries.batch_kpi(enrich(activity(spark, SF_SMALL)))
    whole = history.kpi_history(kpi).orderBy(F.col("batch_id").desc()).first()
    assert history.newest(kpi).collect() == [whole]
    assert history.newest(kpi.limit(0)).collect() == []
