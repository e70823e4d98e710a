"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the shared tables (or data Spark derives from them), over
whole tables: no id subsets, row caps or prefixes; a ``limit`` appears only
where a top-k report is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actiflow.functions import codecs, rules
from actiflow.operators import history, ranking, summaries
from actiflow.operators.enrich import enrich, parse_event_time, with_age_group
from actiflow.operators.blocks import running
from actiflow.operators.windows import dedup_events, session_kpis, window_kpis
from actiflow.plans import faults, reports
from actiflow.plans.activity import load_activity
from actiflow.plans.synth import synth_events, synth_messages
from actiflow.schemas import CSV_MESSAGE_FIELDS, EVENT_FIELDS
from actiflow.session import apply_session_conf, work_root
from actiflow.sinks.files import delete
from actiflow.sinks.store import ResultStore
from actiflow.sources.events import SourceSpec, read_events
from actiflow.sources.tables import read_table
from actiflow.streaming.late import triggers
from actiflow.streaming.processor import kpi_history_view, late_events, start_event_query, stored_events
from actiflow.streaming.replay import BATCH_FIELD, write_event_files
from actiflow.streaming.segments import current_segments, start_segment_query

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_session_conf(spark)
    return load_activity(spark, sf_dir)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(activity(spark, sf_dir))


def kpi_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.kpi_history(summaries.batch_kpi(enriched(spark, sf_dir)))


# --- mapping, rules, enrichment ------------------------------------------------
register("activity")(activity)
register("enrich")(enriched)


@register("age_groups")
def q_age_groups(spark, sf_dir):
    return (with_age_group(activity(spark, sf_dir))
            .groupBy("age_group").agg(F.count(F.lit(1)).alias("event_count")))


@register("satisfaction_a")
def q_satisfaction_a(spark, sf_dir):
    return activity(spark, sf_dir).select(
        "event_id", "average_rating", "days_since_last_purchase",
        rules.satisfaction_a().alias("satisfaction_level"))


@register("satisfaction_b")
def q_satisfaction_b(spark, sf_dir):
    return activity(spark, sf_dir).select(
        "event_id", "average_rating", rules.satisfaction_b().alias("satisfaction_level"))


# --- rollups -------------------------------------------------------------------
@register("city_summary")
def q_city_summary(spark, sf_dir):
    return summaries.city_summary(enriched(spark, sf_dir))


@register("membership_summary")
def q_membership_summary(spark, sf_dir):
    return summaries.membership_summary(enriched(spark, sf_dir))


@register("customer_segments")
def q_customer_segments(spark, sf_dir):
    return summaries.customer_segments(with_age_group(activity(spark, sf_dir)))


@register("city_segments")
def q_city_segments(spark, sf_dir):
    return summaries.city_segments(activity(spark, sf_dir))


@register("batch_kpi")
def q_batch_kpi(spark, sf_dir):
    return summaries.batch_kpi(enriched(spark, sf_dir))


# --- rankings, history ---------------------------------------------------------
@register("at_risk_ranked")
def q_at_risk_ranked(spark, sf_dir):
    return ranking.at_risk_ranked(enriched(spark, sf_dir))


@register("at_risk_classic")
def q_at_risk_classic(spark, sf_dir):
    return ranking.at_risk_classic(activity(spark, sf_dir))


@register("top_at_risk")
def q_top_at_risk(spark, sf_dir):
    """Report panel: of the newest batch, as all report panels."""
    return ranking.top_at_risk(reports.newest_batch(enriched(spark, sf_dir)), 10)


@register("ordered_events")
def q_ordered_events(spark, sf_dir):
    return ranking.ordered_events(enriched(spark, sf_dir))


@register("latest_events")
def q_latest_events(spark, sf_dir):
    ev = enriched(spark, sf_dir)
    return ranking.latest_events(ev, 10).select(*ev.columns)


register("kpi_history")(kpi_history)


@register("recent_kpis")
def q_recent_kpis(spark, sf_dir):
    return history.recent(summaries.batch_kpi(enriched(spark, sf_dir)), 8)


@register("latest_kpi")
def q_latest_kpi(spark, sf_dir):
    return history.newest(summaries.batch_kpi(enriched(spark, sf_dir)))


# --- codecs --------------------------------------------------------------------
def _variants(flag, key, true_words, false_words):
    pick = (key % len(true_words)).cast("int") + 1
    return (F.when(flag.isNull(), F.lit(None).cast("string"))
            .when(flag, F.element_at(F.array(*[F.lit(w) for w in true_words]), pick))
            .otherwise(F.element_at(F.array(*[F.lit(w) for w in false_words]), pick)))


# Text spellings used to exercise the tolerant boolean parser.
BOOL_TRUE_TEXT = ("TRUE", " yes ", "1", "Y")
BOOL_FALSE_TEXT = ("FALSE", "no", "0", "n")


@register("parse_bool")
def q_parse_bool(spark, sf_dir):
    text = _variants(F.col("discount_applied"), F.col("o_orderkey"), BOOL_TRUE_TEXT, BOOL_FALSE_TEXT)
    return (activity(spark, sf_dir)
            .select("event_id", text.alias("discount_text"))
            .withColumn("discount_applied", rules.parse_bool("discount_text")))


@register("encode_json")
def q_encode_json(spark, sf_dir):
    frame = codecs.encode_json(activity(spark, sf_dir), key="event_id")
    return frame.select(F.col("key").cast("string").alias("event_id"),
                        F.col("value").cast("string").alias("value"))


@register("decode_json")
def q_decode_json(spark, sf_dir):
    frame = codecs.encode_json(activity(spark, sf_dir), key="event_id")
    decoded = codecs.decode_json(frame)
    return decoded.withColumn("event_time", parse_event_time("event_time")).select(*EVENT_FIELDS)


@register("encode_csv")
def q_encode_csv(spark, sf_dir):
    ev = activity(spark, sf_dir)
    return ev.select("event_id", codecs.csv_text(ev).alias("value"))


@register("decode_csv")
def q_decode_csv(spark, sf_dir):
    frame = codecs.encode_csv(activity(spark, sf_dir))
    return codecs.decode_csv(frame).select(*CSV_MESSAGE_FIELDS)


@register("valid_rejects")
def q_valid_rejects(spark, sf_dir):
    ev = activity(spark, sf_dir)
    frame = ev.select(F.col("o_orderkey").alias("offset"),
                      faults.damage(codecs.json_text(ev), F.col("o_orderkey"), F.col("event_id"))
                      .cast("binary").alias("value"))
    decoded = codecs.decode_json(frame, keep=["offset"])
    decoded = decoded.withColumn("event_time", parse_event_time("event_time"))
    checked = codecs.with_validity(decoded)
    return checked.select("offset", "event_id",
                          F.col("reject_reason").isNull().alias("is_valid"), "reject_reason")


# --- streaming (file replay of the activity table, availableNow trigger) -------
# Micro-batches of a replay: a quarter of its files each.
REPLAY_BATCHES = 4


def _replay(spark: SparkSession, sf_dir: str, purpose: str):
    """Write the activity events as JSON-lines files (with the producer batch
    number) and return (root, stream of decoded events). Folders are fresh per
    run. As many files as the session has shuffle partitions."""
    root = work_root(spark, purpose)
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_event_files(activity(spark, sf_dir), f"{root}/input", num_files=files)
    spec = SourceSpec(kind="files", path=f"{root}/input",
                      max_files_per_trigger=max(1, files // REPLAY_BATCHES), extra_fields=[BATCH_FIELD])
    return root, read_events(spark, spec, streaming=True)


def _run_event_stream(spark: SparkSession, sf_dir: str, purpose: str) -> ResultStore:
    root, stream = _replay(spark, sf_dir, purpose)
    store = ResultStore(spark, f"{root}/store")
    query = start_event_query(enrich(stream), store, f"{root}/checkpoint", available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return store


@register("stream_events")
def q_stream_events(spark, sf_dir):
    store = _run_event_stream(spark, sf_dir, "stream_events")
    return stored_events(store).select(*EVENT_FIELDS, "batch_id", "is_at_risk", "high_value_order")


@register("stream_kpis")
def q_stream_kpis(spark, sf_dir):
    return kpi_history_view(_run_event_stream(spark, sf_dir, "stream_kpis"))


def _run_segment_stream(spark, sf_dir, table) -> DataFrame:
    root, stream = _replay(spark, sf_dir, f"stream_{table}")
    store = ResultStore(spark, f"{root}/store")
    query = start_segment_query(stream, store, f"{root}/checkpoint", available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return current_segments(store, table)


@register("stream_segments")
def q_stream_segments(spark, sf_dir):
    return _run_segment_stream(spark, sf_dir, "customer_segments")


@register("stream_city_segments")
def q_stream_city_segments(spark, sf_dir):
    return _run_segment_stream(spark, sf_dir, "city_segments")


# Fixed values of the late replay: events arrive in slices of two years from 1995 on, those
# with o_orderkey % 50 = 3 one slice later, = 4 two slices later (in the last one at most);
# events 30 days or less behind are not late.
LATE_SLICES = 4
LATE_FROM_YEAR = 1995
LATE_AFTER = "30 days"


def _run_late_stream(spark: SparkSession, sf_dir: str, purpose: str) -> ResultStore:
    """Every slice arrives, then the query runs until it has read it: one epoch per slice."""
    root = work_root(spark, purpose)
    store = ResultStore(spark, f"{root}/store")
    behind = F.when(F.col("o_orderkey") % 50 == 3, 1).when(F.col("o_orderkey") % 50 == 4, 2).otherwise(0)
    due = F.floor((F.year("event_time") - LATE_FROM_YEAR) / 2).cast("int")
    arrivals = activity(spark, sf_dir).withColumn("slice", F.least(due + behind, F.lit(LATE_SLICES - 1)))
    # The mapping is computed once; each slice then reads its own partition of the stored events.
    arrivals.filter(F.col("slice") >= 0).write.partitionBy("slice").parquet(f"{root}/arrivals")
    arrivals = spark.read.schema(arrivals.schema).parquet(f"{root}/arrivals")
    spec = SourceSpec(kind="files", path=f"{root}/input/*", extra_fields=[BATCH_FIELD])
    for k in range(LATE_SLICES):
        write_event_files(arrivals.filter(F.col("slice") == k), f"{root}/input/slice-{k}")
        query = start_event_query(enrich(read_events(spark, spec, streaming=True)), store, f"{root}/checkpoint",
                                  late_after=LATE_AFTER, available_now=True)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    delete(spark, f"{root}/arrivals")
    return store


@register("late_events")
def q_late_events(spark, sf_dir):
    return late_events(_run_late_stream(spark, sf_dir, "late_events")).select(
        *EVENT_FIELDS, "batch_id", "epoch", "watermark")


@register("trigger_counts")
def q_trigger_counts(spark, sf_dir):
    return triggers(_run_late_stream(spark, sf_dir, "trigger_counts")).drop("generation")


# --- additions: upsert read, de-duplication, event-time windows -----------------
@register("segment_upsert")
def q_segment_upsert(spark, sf_dir):
    """Upsert read: every batch adds a partial state of the segments it touches; a segment's
    current value is the merge of all its states."""
    keys = summaries.SEGMENT_KEYS["customer_segments"]
    states = (with_age_group(activity(spark, sf_dir)).groupBy(*keys, "batch_id")
              .agg(*summaries.segment_state()))
    return summaries.merge_segment_state(states, keys)


@register("dedup_events")
def q_dedup_events(spark, sf_dir):
    """Every event delivered twice (at-least-once replay); one copy survives.
    The copies come from one computation of the events (explode), not two."""
    ev = activity(spark, sf_dir).select(*EVENT_FIELDS)
    twice = ev.withColumn("_delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_delivery")
    return dedup_events(twice, "event_id")


@register("window_kpis")
def q_window_kpis(spark, sf_dir):
    apply_session_conf(spark)
    return window_kpis(read_table(spark, sf_dir, "events", ["ts", "event_type", "value"]))


@register("session_kpis")
def q_session_kpis(spark, sf_dir):
    apply_session_conf(spark)
    return session_kpis(read_table(spark, sf_dir, "events", ["ts", "user_id", "value"]))


# --- synthesis -----------------------------------------------------------------
@register("synth_events")
def q_synth_events(spark, sf_dir):
    """Seed = the activity table with a dense row number; one synthetic event per seed row."""
    seed = running(activity(spark, sf_dir), "o_orderkey", row_number="_rn")
    seed = seed.withColumn("row_no", F.col("_rn") - 1).drop("_rn")
    return synth_events(seed, seed.select((F.col("row_no") + 1).alias("i")))


@register("synth_messages")
def q_synth_messages(spark, sf_dir):
    apply_session_conf(spark)
    ids = read_table(spark, sf_dir, "events", ["event_id"])
    return synth_messages(ids.select((F.col("event_id") + 1).alias("i")))


# --- reports (from the batch results) ------------------------------------------
@register("report_cards")
def q_report_cards(spark, sf_dir):
    return reports.report_cards(history.newest(summaries.batch_kpi(enriched(spark, sf_dir))))


@register("report_bars")
def q_report_bars(spark, sf_dir):
    newest = reports.newest_batch(enriched(spark, sf_dir))
    return reports.report_bars(summaries.city_summary(newest), summaries.membership_summary(newest))


@register("report_summary")
def q_report_summary(spark, sf_dir):
    return reports.report_summary_of(enriched(spark, sf_dir))
