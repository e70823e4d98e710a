"""Top-k panels."""

import datetime as dt

from actiflow.operators import ranking


def test_latest_events_never_spill_into_older_batches(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(f"e{i}", t + dt.timedelta(minutes=i), 1) for i in range(20)]
    rows += [("z1", t, 2), ("z0", t, 2), ("n", t, None)]   # newest batch has 2 rows
    df = spark.createDataFrame(rows, "event_id string, event_time timestamp, batch_id int")
    got = [r["event_id"] for r in ranking.latest_events(df, 10).collect()]
    assert got == ["z0", "z1"]


def test_latest_events_takes_first_n_of_newest_batch(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(f"e{i:02d}", t + dt.timedelta(minutes=i % 5), 3) for i in range(30)]
    df = spark.createDataFrame(rows, "event_id string, event_time timestamp, batch_id int")
    got = [r["event_id"] for r in ranking.latest_events(df, 4).collect()]
    assert got == ["e00", "e05", "e10", "e15"]
