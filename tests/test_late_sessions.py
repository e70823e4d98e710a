"""Late events, trigger counts and sessions; each stream against its batch twin."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from actiflow.operators.windows import session_kpis, session_kpis_stream
from actiflow.sinks.store import ResultStore
from actiflow.sources.events import SourceSpec
from actiflow.sources.tables import read_table
from actiflow.streaming.job import RunLimits, run_event_job
from actiflow.streaming.late import triggers
from actiflow.streaming.processor import EventBatchWriter, late_events
from conftest import SF_SMALL

DAY = dt.datetime(2024, 1, 1)


def _lines(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as fh:
        for event_id, hour in rows:
            time = f'"{(DAY + dt.timedelta(hours=hour)).isoformat()}Z"' if hour is not None else '"nope"'
            fh.write(f'{{"event_id":"{event_id}","event_time":{time},"customer_id":1,"total_spend":10.0}}\n')


def test_kept_late_and_rejected_are_all_that_was_read(spark, workdir):
    spec = SourceSpec(path=f"{workdir}/in")
    slices = [[("a", 0), ("b", 5), ("old", -90)],     # nothing is late before anything came
              [("c", 4), ("d", 3.5), ("e", 2), ("bad", None), ("f", 9)],
              [("g", 6), ("h", 8)], [("i", 7.9), ("j", 30)]]
    for k, rows in enumerate(slices):  # every run is a new process to the store
        _lines(f"{workdir}/in", f"s{k}", rows)
        out = run_event_job(spark, spec, f"{workdir}/store", f"{workdir}/ckpt", RunLimits(available_now=True),
                            late_after="1 hour")
    store = ResultStore(spark, f"{workdir}/store")
    assert sorted((r.event_id, r.epoch) for r in late_events(store).collect()) == [
        ("d", 1), ("e", 1), ("g", 2), ("i", 3)]
    counts = [(r.rows_read, r.kept, r.late, r.rejected, r.watermark and (r.watermark - DAY).total_seconds() / 3600)
              for r in triggers(store).orderBy("epoch").collect()]
    assert counts == [(3, 3, 0, 0, None), (5, 2, 2, 1, 4.0), (2, 1, 1, 0, 8.0), (2, 1, 1, 0, 8.0)]
    assert all(read == kept + late + rejected for read, kept, late, rejected, _ in counts)
    assert sorted(r.event_id for r in store.read("events").collect()) == ["a", "b", "c", "f", "h", "j", "old"]
    assert {r.card: r.value for r in out["cards"].collect()}["Total Events"] == "7"


def test_a_replayed_epoch_splits_the_same_way(spark, workdir):
    from actiflow.operators.enrich import enrich
    from actiflow.schemas import EVENT_SCHEMA
    def batch(rows):
        base = spark.createDataFrame([(i, DAY + dt.timedelta(hours=h)) for i, h in rows], "event_id STRING, event_time TIMESTAMP_NTZ")
        cols = [F.col(f.name) if f.name in base.columns else F.lit(1 if f.name == "customer_id" else None)
                .cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields]
        return enrich(base.select(*cols))
    store = ResultStore(spark, f"{workdir}/store")
    first, second = batch([("a", 0), ("b", 10)]), batch([("c", 8), ("d", 9.5), ("e", 50)])
    for writer in (EventBatchWriter(store, late_after="1 hour"), EventBatchWriter(store, late_after="1 hour")):
        writer(first, 0)
        writer(second, 1)
        writer(second, 1)  # replayed in the same process, then all of it in another
        assert [r.event_id for r in late_events(store).collect()] == ["c"]
        assert sorted(r.event_id for r in store.read("events").collect()) == ["a", "b", "d", "e"]


def test_the_late_replay_computes_its_events_once(spark, monkeypatch):
    from actiflow.plans import catalog
    from actiflow.schemas import EVENT_SCHEMA
    rows = [("before", 11, "1994-05-01"), ("behind", 53, "1994-06-01"), ("first", 1, "1995-06-01"),
            ("late", 3, "1995-02-01"), ("near", 103, "1995-05-20"), ("second", 2, "1997-06-01"),
            ("later", 4, "1995-03-01"), ("third", 5, "1999-06-01"), ("fourth", 6, "2003-06-01"), ("no time", 7, None)]
    base = spark.createDataFrame(rows, "event_id STRING, o_orderkey BIGINT, day STRING").select(
        "event_id", "o_orderkey", F.to_timestamp_ntz("day").alias("event_time"))
    cols = [F.col(f.name) if f.name in base.columns else F.lit(1 if f.name == "customer_id" else None)
            .cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields]
    events = base.select(*cols, "o_orderkey", F.col("o_orderkey").alias("batch_id"))
    computed = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(catalog, "activity", lambda spark, sf_dir: events.mapInArrow(counting, events.schema))
    store = catalog._run_late_stream(spark, None, "late_events")
    assert computed.value == len(rows)
    assert [(r.event_id, r.epoch) for r in late_events(store).orderBy("epoch").collect()] == [
        ("late", 1), ("later", 2)]
    counts = triggers(store).orderBy("epoch").collect()
    assert [(r.rows_read, r.kept, r.late, r.rejected) for r in counts] == [
        (2, 2, 0, 0), (3, 2, 1, 0), (2, 1, 1, 0), (2, 1, 0, 1)]


EVENTS = "user_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE"


def sessions_plain(rows, gap):
    out, by = [], {}
    for user, ts, value in rows:
        if ts is not None:
            by.setdefault(user, []).append((ts, value))
    for user, events in by.items():
        run = []
        for ts, value in sorted(events, key=lambda e: e[0]) + [(None, None)]:
            if run and (ts is None or (ts - run[-1][0]).total_seconds() > gap):
                values = [v for _, v in run if v is not None]
                out.append((user, run[0][0], run[-1][0] + dt.timedelta(seconds=gap), len(run),
                            round(sum(values), 2) if values else None))
                run = []
            if ts is not None:
                run.append((ts, value))
    return sorted(out, key=str)


def test_sessions_against_plain_runs(spark):
    import random
    rng = random.Random(5)
    rows = [(rng.randrange(4), DAY + dt.timedelta(seconds=rng.randrange(-40_000, 40_000)), float(rng.randrange(100)))
            for _ in range(300)]
    at = lambda s: DAY + dt.timedelta(seconds=s)
    rows += [(9, at(0), 1.0), (9, at(600), 2.0), (9, at(1200), 3.0), (9, at(1801), 4.0),   # at most one gap apart: one
             (9, at(1801), None), (None, at(5), 1.0), (None, at(6), 1.0), (7, None, 1.0),
             (8, dt.datetime(1969, 12, 31, 23, 59), 1.0), (8, dt.datetime(1970, 1, 1, 0, 5), 1.0)]
    df = spark.createDataFrame(rows, EVENTS).repartition(5)
    got = session_kpis(df, gap_seconds=600)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sessions_plain(rows, 600)
    assert session_kpis(df.limit(0)).count() == 0


def test_a_hot_user_is_summed_before_it_is_sorted(spark):
    # A third of a million events of one user in a day are 48 cells of half an hour.
    df = spark.range(300_000).select(F.lit(1).cast("bigint").alias("user_id"),
                                     F.timestamp_micros(F.lit(1704067200000000) + F.col("id") * 288_000)
                                     .cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("value"))
    rows = session_kpis(df).collect()
    assert [(r.event_count, r.total_value) for r in rows] == [(300_000, 300_000.0)]


def test_session_stream_equals_batch_and_closes_by_watermark(spark, workdir):
    ev = read_table(spark, SF_SMALL, "events").select("user_id", "ts", "value")
    # In the order of time, with an event a month later that closes all sessions.
    last = ev.agg((F.max("ts") + F.expr("INTERVAL 40 DAYS")).alias("ts")).select(
        F.lit(-1).cast("bigint").alias("user_id"), "ts", F.lit(0.0).alias("value"))
    halves = ev.agg(F.expr("timestampadd(SECOND, timestampdiff(SECOND, min(ts), max(ts)) div 2, min(ts))")).first()[0]
    slices = [ev.filter(F.col("ts") < halves), ev.filter(F.col("ts") >= halves), last]
    emitted = []
    for k, part in enumerate(slices):
        part.write.parquet(f"{workdir}/in/s{k}")
        stream = spark.readStream.schema(ev.schema).parquet(f"{workdir}/in/*")
        q = (session_kpis_stream(stream, "1 hour").writeStream.outputMode("append").format("parquet")
             .option("path", f"{workdir}/out").option("checkpointLocation", f"{workdir}/ckpt")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None
        emitted.append(spark.read.parquet(f"{workdir}/out").count())
    assert 0 < emitted[0] < emitted[-1]  # sessions leave as the watermark passes them
    got = spark.read.parquet(f"{workdir}/out").select(
        "user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_end").cast("timestamp_ntz").alias("session_end"), "event_count", "total_value")
    assert sorted(map(str, got.collect())) == sorted(map(str, session_kpis(ev).collect()))


def test_session_stream_leaves_out_what_is_behind_the_watermark(spark, workdir):
    rows = [[(1, DAY, 1.0), (1, DAY + dt.timedelta(hours=10), 1.0)], [(1, DAY + dt.timedelta(hours=1), 1.0)],
            [(2, DAY + dt.timedelta(hours=30), 1.0)]]
    for k, part in enumerate(rows):
        spark.createDataFrame(part, EVENTS).coalesce(1).write.parquet(f"{workdir}/in/s{k}")
        stream = spark.readStream.schema(EVENTS).parquet(f"{workdir}/in/*")
        q = (session_kpis_stream(stream, "2 hours").writeStream.outputMode("append").format("parquet")
             .option("path", f"{workdir}/out").option("checkpointLocation", f"{workdir}/ckpt")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    got = sorted(r.session_start.hour for r in spark.read.parquet(f"{workdir}/out").filter("user_id = 1").collect())
    assert got == [0, 10]


@pytest.mark.parametrize("gap", [60, 3600])
def test_session_totals_keep_all_events(spark, gap):
    ev = read_table(spark, SF_SMALL, "events")
    got = session_kpis(ev, gap_seconds=gap).agg(F.sum("event_count")).first()[0]
    assert got == ev.count()
