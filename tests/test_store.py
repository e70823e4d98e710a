"""Result store: generations of checkpoints, snapshots that stay whole, compaction."""

import os

import pytest
from pyspark.sql import functions as F

from actiflow.operators import history, summaries
from actiflow.operators.enrich import enrich
from actiflow.plans.catalog import activity
from actiflow.sinks.store import NO_CHECKPOINT, ResultStore, compaction_note
from actiflow.sources.events import SourceSpec, read_events
from actiflow.streaming.processor import (EventBatchWriter, compact_kpis, kpi_history_view, latest_snapshots,
                                          recent_kpi_view, start_event_query)
from actiflow.streaming.replay import BATCH_FIELD, write_event_files
from actiflow.streaming.segments import compact_segments, current_segments, start_segment_query
from conftest import SF_SMALL


def _run(spark, events, workdir, name, store, checkpoint, start=start_event_query):
    write_event_files(events, f"{workdir}/{name}", num_files=2)
    spec = SourceSpec(path=f"{workdir}/{name}", max_files_per_trigger=1, extra_fields=[BATCH_FIELD])
    stream = read_events(spark, spec)
    q = start(enrich(stream) if start is start_event_query else stream, store, f"{workdir}/{checkpoint}",
              available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_a_new_checkpoint_replaces_nothing(spark, workdir):
    ev = activity(spark, SF_SMALL)
    halves = [ev.filter(F.crc32("event_id") % 2 == k) for k in range(2)]
    store = ResultStore(spark, f"{workdir}/store")
    for k, half in enumerate(halves):  # both count epochs from 0
        q = _run(spark, half, workdir, f"in{k}", store, f"ckpt{k}")
        assert store.generation(f"{workdir}/ckpt{k}") == f"{k + 1:06d}-{q.id}"
    stored = store.read("events")
    assert stored.count() == ev.count()
    assert sorted((r.generation[:6], r.epoch) for r in stored.select("generation", "epoch").distinct().collect()) == [
        ("000001", 0), ("000001", 1), ("000002", 0), ("000002", 1)]
    want = sorted(map(str, summaries.batch_kpi(enrich(ev)).select("batch_id", "event_count", "avg_spend").collect()))
    view = lambda: sorted(map(str, kpi_history_view(store).select("batch_id", "event_count", "avg_spend").collect()))
    assert view() == want
    # The newest version is the last epoch of the last checkpoint.
    newest = latest_snapshots(store)["latest_events"].select("generation", "epoch").distinct().collect()
    assert [(r.generation[:6], r.epoch) for r in newest] == [("000002", 1)]
    # A compaction holds old epochs of both and hides none of the others.
    compact_kpis(store, keep_epochs=1)
    assert view() == want and list(compaction_note(store, "kpi_parts")["cover"].values()) == [0, 0]
    _run(spark, halves[0].withColumn("batch_id", F.col("batch_id") + 1000), workdir, "in2", store, "ckpt2")
    assert sum(r.event_count for r in kpi_history_view(store).collect()) == ev.count() + halves[0].count()
    compact_kpis(store, keep_epochs=1)
    assert sum(r.event_count for r in kpi_history_view(store).collect()) == ev.count() + halves[0].count()


def test_segments_of_two_checkpoints_add_up(spark, workdir):
    ev = activity(spark, SF_SMALL)
    store = ResultStore(spark, f"{workdir}/store")
    for k in range(2):
        _run(spark, ev.filter(F.crc32("event_id") % 2 == k), workdir, f"in{k}", store, f"ckpt{k}", start_segment_query)
    want = sorted(map(str, summaries.city_segments(ev).collect()))
    assert sorted(map(str, current_segments(store, "city_segments").collect())) == want
    compact_segments(store, "city_segments", keep_epochs=1)
    assert sorted(map(str, current_segments(store, "city_segments").collect())) == want


def test_a_restart_keeps_its_generation(spark, workdir):
    ev = activity(spark, SF_SMALL)
    store = ResultStore(spark, f"{workdir}/store")
    _run(spark, ev, workdir, "in", store, "ckpt")
    first = store.generation(f"{workdir}/ckpt")
    spec = SourceSpec(path=f"{workdir}/in", extra_fields=[BATCH_FIELD])
    start_event_query(enrich(read_events(spark, spec)), store, f"{workdir}/ckpt", available_now=True).awaitTermination()
    assert ResultStore(spark, f"{workdir}/store").generation(f"{workdir}/ckpt") == first
    assert store.read("generations").count() == 1 and store.generation(None) == NO_CHECKPOINT


def test_snapshots_survive_a_failed_write(spark, workdir):
    store = ResultStore(spark, f"{workdir}/store")
    schema = spark.range(1).schema
    assert store.read_snapshot("numbers", schema).count() == 0
    with pytest.raises(FileNotFoundError):
        store.read_snapshot("numbers")
    store.write_snapshot(spark.range(5), "numbers")
    open_reader = store.read_snapshot("numbers")
    broken = spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(
        F.raise_error(F.lit("lost in the middle")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="lost in the middle"):
        store.write_snapshot(broken, "numbers")
    assert store.read_snapshot("numbers").count() == 5
    store.write_snapshot(spark.range(7), "numbers", note="seven")
    assert store.read_snapshot("numbers").count() == 7 and store.snapshot_note("numbers") == "seven"
    assert open_reader.count() == 5  # a reader that began before reads on
    store.write_snapshot(spark.range(0), "numbers")
    assert store.read_snapshot("numbers").count() == 0
    assert store.expire_snapshots("numbers", keep=1) == 2
    assert store.read_snapshot("numbers").count() == 0 and store.expire_snapshots("numbers", keep=1) == 0
    assert len(os.listdir(f"{workdir}/store/numbers/versions")) == 2  # the newest, and what failed
    with pytest.raises(ValueError):
        store.expire_snapshots("numbers", keep=0)


def test_compaction_reads_pruned_versions(spark, workdir):
    ev = enrich(activity(spark, SF_SMALL)).drop("o_orderkey")
    store = ResultStore(spark, f"{workdir}/store")
    writer = EventBatchWriter(store)
    for k in range(3):
        writer(ev.filter(F.crc32("event_id") % 3 == k), k)
    compact_kpis(store, keep_epochs=1)
    from actiflow.streaming.processor import kpi_parts
    plan = kpi_parts(store)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and kpi_parts(store).filter("epoch < 2").select("epoch").distinct().count() == 1
    with pytest.raises(ValueError):
        compact_kpis(store, keep_epochs=0)


def test_running_totals_go_on_from_a_compaction(spark, workdir):
    ev = enrich(activity(spark, SF_SMALL)).drop("o_orderkey")
    ev = ev.withColumn("batch_id", F.floor(F.crc32("event_id") / F.lit(1 << 28)).cast("long"))  # 16 batches
    store = ResultStore(spark, f"{workdir}/store")
    writer = EventBatchWriter(store)
    for k in range(4):  # four batches in each epoch
        writer(ev.filter(F.floor(F.col("batch_id") / 4) == k), k)
    want = list(map(str, history.kpi_history(summaries.batch_kpi(ev)).orderBy("batch_id").collect()))
    view = lambda: list(map(str, kpi_history_view(store).orderBy("batch_id").collect()))
    recent = lambda n: list(map(str, recent_kpi_view(store, n).collect()))
    assert recent(3) == want[::-1][:3]
    compact_kpis(store, keep_epochs=2)
    note = compaction_note(store, "kpi_parts")
    assert (note["batches"], note["last_batch"]) == (8, 7)
    assert view() == want and [recent(n) for n in (8, 99)] == [want[::-1][:n] for n in (8, 99)]
    # Eight batches came after: only their partials are read, and no running total over others.
    compacted = f"compacted/versions/{store._pointer('kpi_parts_compacted')['folder']}"
    read = lambda df: any(compacted in f for f in df.inputFiles())
    assert not read(recent_kpi_view(store, 8)) and read(recent_kpi_view(store, 9)) and read(kpi_history_view(store))
    # Events of a compacted batch move all later totals.
    some = ev.filter(F.crc32("event_id") % 97 == 0)
    late = some.withColumn("batch_id", F.lit(2).cast("long"))
    writer(late, 4)
    both = list(map(str, history.kpi_history(summaries.batch_kpi(ev.unionByName(late))).orderBy("batch_id").collect()))
    assert view() == both != want and recent(3) == both[::-1][:3]
    writer(some.withColumn("batch_id", F.lit(50).cast("long")), 5)
    compact_kpis(store, keep_epochs=1)
    assert view()[:-1] == both and recent(1) == view()[-1:]
