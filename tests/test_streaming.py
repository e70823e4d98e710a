"""Stream = batch, restarts and replays change nothing, stop rules terminate."""

import os

from pyspark.sql import functions as F

from actiflow.operators import history, summaries
from actiflow.operators.enrich import enrich
from actiflow.plans.catalog import activity
from actiflow.sinks.store import ResultStore, compaction_note
from actiflow.sources.events import SourceSpec, read_events
from actiflow.streaming.control import run_until
from actiflow.streaming.late import triggers
from actiflow.streaming.processor import EventBatchWriter, kpi_history_view, start_event_query
from actiflow.streaming.replay import BATCH_FIELD, write_event_files
from actiflow.streaming.segments import current_segments, start_segment_query
from conftest import SF_SMALL


def _stream(spark, root, files_per_trigger=1):
    spec = SourceSpec(kind="files", path=f"{root}/input", max_files_per_trigger=files_per_trigger,
                      extra_fields=[BATCH_FIELD])
    return read_events(spark, spec)


def test_stream_equals_batch_and_restart_adds_nothing(spark, workdir):
    ev = activity(spark, SF_SMALL)
    write_event_files(ev, f"{workdir}/input", num_files=4)
    store = ResultStore(spark, f"{workdir}/store")
    q = start_event_query(enrich(_stream(spark, workdir)), store, f"{workdir}/ckpt",
                          available_now=True)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4
    expected = history.kpi_history(summaries.batch_kpi(enrich(ev))).collect()
    assert sorted(kpi_history_view(store).collect()) == sorted(expected)
    # restart on the same checkpoint: no new input, no new rows
    q2 = start_event_query(enrich(_stream(spark, workdir)), store, f"{workdir}/ckpt",
                           available_now=True)
    q2.awaitTermination()
    assert store.read("events").count() == ev.count()
    assert sorted(kpi_history_view(store).collect()) == sorted(expected)


def test_replayed_epoch_is_idempotent(spark, workdir):
    ev = enrich(activity(spark, SF_SMALL)).drop("o_orderkey")
    store = ResultStore(spark, f"{workdir}/store")
    writer = EventBatchWriter(store)
    writer(ev, 0)
    writer(ev, 0)  # at-least-once delivery replays the same epoch
    assert store.read("events").count() == ev.count()
    assert store.read("kpi_parts").agg(F.sum("event_count")).first()[0] == ev.count()


def test_bad_file_goes_to_rejects(spark, workdir):
    os.makedirs(f"{workdir}/input")
    with open(f"{workdir}/input/part-bad.json", "w") as fh:
        fh.write('{"event_id":"e1","event_time":"2024-01-01T00:00:00Z","customer_id":1,"batch_id":1}\n')
        fh.write("garbage\n")
        fh.write('{"event_id":"e2","event_time":"nope","customer_id":2,"batch_id":1}\n')
    store = ResultStore(spark, f"{workdir}/store")
    q = start_event_query(enrich(_stream(spark, workdir)), store, f"{workdir}/ckpt",
                          available_now=True)
    q.awaitTermination()
    assert store.read("events").count() == 1
    reasons = sorted(r[0] for r in store.read("rejects").select("reject_reason").collect())
    assert reasons == ["missing event_id", "missing event_time"]


def test_segments_stream_equals_batch(spark, workdir):
    ev = activity(spark, SF_SMALL)
    write_event_files(ev, f"{workdir}/input", num_files=3)
    store = ResultStore(spark, f"{workdir}/store")
    q = start_segment_query(_stream(spark, workdir), store, f"{workdir}/ckpt", available_now=True)
    q.awaitTermination()
    # both grains from one read of the source
    assert sum(p["numInputRows"] for p in q.recentProgress) == ev.count()
    from actiflow.operators.enrich import with_age_group
    expected = summaries.customer_segments(with_age_group(ev)).collect()
    assert sorted(current_segments(store, "customer_segments").collect()) == sorted(expected)
    assert (sorted(current_segments(store, "city_segments").collect())
            == sorted(summaries.city_segments(ev).collect()))


def test_run_until_stops_idle_stream(spark, workdir):
    os.makedirs(f"{workdir}/input")
    store = ResultStore(spark, f"{workdir}/store")
    q = start_event_query(enrich(_stream(spark, workdir)), store, f"{workdir}/ckpt",
                          trigger_seconds=0.5)
    assert run_until(q, max_batches=5, idle_seconds=3) == 0
    assert not q.isActive


def _events_stream(spark, workdir, copies=1):
    from actiflow.sources.tables import read_table
    ev = read_table(spark, SF_SMALL, "events")
    for k in range(copies):
        ev.write.parquet(f"{workdir}/events_in/copy={k}")
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
              .parquet(f"{workdir}/events_in/*"))
    return ev, stream


def test_window_kpis_stream_equals_batch(spark, workdir):
    from actiflow.operators.windows import window_kpis
    ev, stream = _events_stream(spark, workdir)
    q = (window_kpis(stream, watermark="1 day").writeStream.outputMode("update")
         .foreachBatch(lambda df, e: df.write.mode("append").parquet(f"{workdir}/win"))
         .option("checkpointLocation", f"{workdir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    updates = spark.read.parquet(f"{workdir}/win")
    # the last update of each window is its final value
    got = (updates.groupBy(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                           "event_type")
           .agg(F.max("event_count").alias("event_count")))
    expected = window_kpis(ev).select("window_start", "event_type", "event_count")
    assert sorted(got.collect()) == sorted(expected.collect())


def test_stream_dedup_within_watermark(spark, workdir):
    from actiflow.operators.windows import dedup_events
    ev, stream = _events_stream(spark, workdir, copies=2)   # every event delivered twice
    deduped = dedup_events(stream, "event_id", time_col="ts", watermark="2 days")
    q = (deduped.writeStream.format("parquet").option("path", f"{workdir}/dedup")
         .option("checkpointLocation", f"{workdir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(f"{workdir}/dedup")
    assert out.count() == out.select("event_id").distinct().count() == ev.count()


def test_event_job_end_to_end(spark, workdir):
    from actiflow.streaming.job import RunLimits, run_event_job
    ev = activity(spark, SF_SMALL)
    write_event_files(ev, f"{workdir}/input", num_files=3)
    spec = SourceSpec(kind="files", path=f"{workdir}/input", max_files_per_trigger=1,
                      extra_fields=[BATCH_FIELD])
    out = run_event_job(spark, spec, f"{workdir}/store", f"{workdir}/ckpt",
                        RunLimits(available_now=True))
    cards = {r["card"]: r["value"] for r in out["cards"].collect()}
    assert cards["Total Events"] == str(ev.count())
    assert out["latest_events"].count() == 10
    saved = ResultStore(spark, f"{workdir}/store").read_snapshot("reports/cards")
    assert sorted(saved.collect()) == sorted(out["cards"].collect())


def test_segment_job_on_csv_messages(spark, workdir):
    from actiflow.functions import codecs
    from actiflow.streaming.job import RunLimits, run_segment_job
    ev = activity(spark, SF_SMALL)
    codecs.encode_csv(ev).select(F.col("value").cast("string")).write.text(f"{workdir}/csv")
    spec = SourceSpec(kind="files", path=f"{workdir}/csv", value_format="csv",
                      max_files_per_trigger=2)
    current = run_segment_job(spark, spec, f"{workdir}/store", f"{workdir}/ckpt",
                              RunLimits(available_now=True))
    got = current["city_segments"].orderBy("city").collect()
    want = summaries.city_segments(codecs.decode_csv(codecs.encode_csv(ev))).orderBy("city").collect()
    assert got == want


def test_queries_run_together(spark, workdir):
    from actiflow.streaming.control import await_all, run_all_until
    ev = activity(spark, SF_SMALL)
    write_event_files(ev, f"{workdir}/input", num_files=2)
    store = ResultStore(spark, f"{workdir}/store")
    queries = [start_segment_query(_stream(spark, workdir), store, f"{workdir}/ckpt/segments", trigger_seconds=0.5),
               start_event_query(enrich(_stream(spark, workdir)), store, f"{workdir}/ckpt/events", trigger_seconds=0.5)]
    assert run_all_until(queries, idle_seconds=4, spark=spark) == [2, 2]   # both ran, then both were idle
    await_all(spark, queries, timeout_seconds=1)
    assert sorted(current_segments(store, "city_segments").collect()) == sorted(summaries.city_segments(ev).collect())
    assert store.read("events").count() == ev.count()


def test_kpi_per_micro_batch_without_producer_batch(spark, workdir):
    # events without a batch number (e.g. from Kafka): each epoch is one KPI row
    ev = enrich(activity(spark, SF_SMALL)).drop("o_orderkey")
    first = ev.filter(F.col("batch_id") == 0).drop("batch_id")
    second = ev.filter(F.col("batch_id") == 1).drop("batch_id")
    store = ResultStore(spark, f"{workdir}/store")
    writer = EventBatchWriter(store)
    writer(first, 7)
    writer(second, 8)
    rows = kpi_history_view(store).orderBy("batch_id").collect()
    assert [r["batch_id"] for r in rows] == [7, 8]
    assert [r["processed_batches"] for r in rows] == [1, 2]
    assert rows[1]["cumulative_event_count"] == first.count() + second.count()


def test_generator_to_stream_demo(spark, workdir):
    # the reference's demo: generator writes batch files, the processor streams them
    from actiflow.plans.synth import synth_events
    seed = activity(spark, SF_SMALL).withColumn("row_no", F.col("o_orderkey"))
    idx = spark.range(1, 101).select(F.col("id").alias("i"))       # 5 batches of 20
    events = synth_events(seed, idx, batch_size=20).withColumnRenamed("batch_no", "batch_id")
    write_event_files(events, f"{workdir}/input", num_files=5)
    store = ResultStore(spark, f"{workdir}/store")
    q = start_event_query(enrich(_stream(spark, workdir)), store, f"{workdir}/ckpt",
                          available_now=True)
    q.awaitTermination()
    got = kpi_history_view(store).orderBy("batch_id").collect()
    want = history.kpi_history(summaries.batch_kpi(enrich(events))).orderBy("batch_id").collect()
    assert got == want and len(got) == 5


def test_job_without_data_gives_empty_reports(spark, workdir):
    from actiflow.streaming.job import RunLimits, run_event_job
    os.makedirs(f"{workdir}/input")
    spec = SourceSpec(kind="files", path=f"{workdir}/input")
    out = run_event_job(spark, spec, f"{workdir}/store", f"{workdir}/ckpt", RunLimits(available_now=True))
    assert {r.card: r.value for r in out["cards"].collect()} == {
        "Processed Batches": "0", "Total Events": "0", "Latest Revenue": "0.00", "At-Risk Customers": "0"}
    assert out["bars"].count() == 0 and out["latest_events"].count() == 0


def test_rejects_keep_the_record_and_its_position(spark, workdir):
    from actiflow.streaming.job import RunLimits, run_event_job
    os.makedirs(f"{workdir}/input")
    bad = ["not json", '{"event_id":"e2","event_time":"nope","customer_id":2}', '{"customer_id":3000000000}']
    with open(f"{workdir}/input/part-0.json", "w") as fh:
        fh.write("\n".join(bad) + "\n\n")
    spec = SourceSpec(kind="files", path=f"{workdir}/input")
    run_event_job(spark, spec, f"{workdir}/store", f"{workdir}/ckpt", RunLimits(available_now=True))
    rejects = ResultStore(spark, f"{workdir}/store").read("rejects").collect()
    assert sorted(r.raw_value for r in rejects) == sorted(bad)
    assert all(r.raw_origin.endswith("part-0.json") for r in rejects)


def test_kafka_frame_and_file_give_equal_columns(spark, workdir):
    from actiflow.schemas import KAFKA_SCHEMA
    from actiflow.sources.events import decode_kafka
    line = '{"event_id":"e1","event_time":"2024-01-01T00:00:00Z","customer_id":1,"batch_id":7}'
    frame = spark.createDataFrame([(None, line.encode(), "t", 3, 11, None, 0)], KAFKA_SCHEMA)
    spec = SourceSpec(kind="kafka", extra_fields=[BATCH_FIELD], keep_raw=True)
    row = decode_kafka(frame, spec).first()
    assert row.batch_id == 7 and row.raw_value == line and row.raw_origin == "t/3/11"
    os.makedirs(f"{workdir}/in")
    with open(f"{workdir}/in/x.json", "w") as fh:
        fh.write(line + "\n")
    files = read_events(spark, SourceSpec(path=f"{workdir}/in", extra_fields=[BATCH_FIELD], keep_raw=True), False)
    assert files.schema == decode_kafka(frame, spec).schema
    assert files.drop("raw_origin").collect() == decode_kafka(frame, spec).drop("raw_origin").collect()


def test_slow_first_batch_is_not_idle(spark, workdir):
    import time
    write_event_files(activity(spark, SF_SMALL), f"{workdir}/input", num_files=2)
    done = []
    q = (_stream(spark, workdir).writeStream
         .foreachBatch(lambda df, e: (time.sleep(6), done.append(df.count())) and None)
         .option("checkpointLocation", f"{workdir}/ckpt").trigger(processingTime="0 seconds").start())
    assert run_until(q, idle_seconds=3) == 2 and len(done) == 2


def test_max_batches_then_restart(spark, workdir):
    ev = activity(spark, SF_SMALL)
    write_event_files(ev, f"{workdir}/input", num_files=4)
    store = ResultStore(spark, f"{workdir}/store")
    q = start_event_query(enrich(_stream(spark, workdir)), store, f"{workdir}/ckpt", trigger_seconds=2)
    assert 2 <= run_until(q, max_batches=2) < 4
    q = start_event_query(enrich(_stream(spark, workdir)), store, f"{workdir}/ckpt", available_now=True)
    q.awaitTermination()
    assert store.read("events").count() == ev.count()
    row = kpi_history_view(store, with_processed_at=True).first()
    assert (row.processed_at is not None) and row.processed_at.year >= 2024


def test_replay_file_count_follows_the_setting(spark, workdir):
    write_event_files(activity(spark, SF_SMALL), f"{workdir}/input")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len([f for f in os.listdir(f"{workdir}/input") if f.endswith(".json")]) == n


def test_stream_dedup_needs_a_watermark(spark, workdir):
    import pytest
    from actiflow.operators.windows import dedup_events
    os.makedirs(f"{workdir}/input")
    with pytest.raises(ValueError):
        dedup_events(_stream(spark, workdir), "event_id")


def test_job_drops_duplicates_but_no_rejects(spark, workdir):
    from actiflow.streaming.job import RunLimits, run_event_job
    os.makedirs(f"{workdir}/input")
    good = '{"event_id":"e1","event_time":"2024-01-01T00:00:00Z","customer_id":1}'
    with open(f"{workdir}/input/part-0.json", "w") as fh:
        fh.write("\n".join([good, good, "bad one", "bad two"]) + "\n")
    spec = SourceSpec(kind="files", path=f"{workdir}/input")
    out = run_event_job(spark, spec, f"{workdir}/store", f"{workdir}/ckpt",
                        RunLimits(available_now=True), dedup_delay="1 hour")
    assert {r.card: r.value for r in out["cards"].collect()}["Total Events"] == "1"
    store = ResultStore(spark, f"{workdir}/store")
    assert store.read("rejects").count() == 2
    # one read of the source: each row once
    assert [(r.rows_read, r.kept, r.rejected) for r in triggers(store).collect()] == [(3, 1, 2)]


def test_compaction_changes_no_result(spark, workdir):
    from actiflow.streaming.processor import compact_kpis
    from actiflow.streaming.segments import UpdateRowsWriter, compact_segments, segment_states
    ev = enrich(activity(spark, SF_SMALL)).drop("o_orderkey").withColumn("batch_id", F.col("batch_id") * 2)
    store = ResultStore(spark, f"{workdir}/store")
    writer, updates = EventBatchWriter(store), UpdateRowsWriter(store)
    parts = [ev.filter(F.crc32("event_id") % 4 == k) for k in range(4)]
    for epoch, part in enumerate(parts):
        writer(part, epoch)
        updates(segment_states(part), epoch)
    kpis = lambda: sorted(map(str, kpi_history_view(store).collect()))
    cities = lambda: sorted(current_segments(store, "city_segments").collect())
    before = kpis(), cities()
    compact_kpis(store, keep_epochs=2)
    compact_segments(store, "city_segments", keep_epochs=2)
    assert (kpis(), cities()) == before
    assert compaction_note(store, "kpi_parts")["cover"] == {"000000-none": 1}
    writer(parts[3], 3)  # a replay after the compaction
    updates(segment_states(parts[3]), 3)
    compact_kpis(store, keep_epochs=1)
    compact_segments(store, "city_segments", keep_epochs=1)
    compact_kpis(store, keep_epochs=1)
    assert (kpis(), cities()) == before


def test_job_script(spark, workdir, capsys):
    from scripts.run_job import main
    write_event_files(activity(spark, SF_SMALL).limit(50), f"{workdir}/input", num_files=1)
    main(["events", "--path", f"{workdir}/input", "--store", f"{workdir}/store",
          "--checkpoint", f"{workdir}/ckpt", "--available-now"])
    assert "Processed Batches" in capsys.readouterr().out
