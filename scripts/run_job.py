"""Run a streaming job with spark-submit.

spark-submit scripts/run_job.py events   --path /data/events --store /out/store --checkpoint /out/ckpt
spark-submit scripts/run_job.py segments --servers broker:9092 --topic messages --format csv ...

Without limits the job runs until it is stopped; --available-now ends it after what is there.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from actiflow.session import get_session  # noqa: E402
from actiflow.sources.events import SourceSpec  # noqa: E402
from actiflow.streaming.job import RunLimits, run_event_job, run_segment_job  # noqa: E402


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=["events", "segments"])
    p.add_argument("--path", help="folder of JSON lines (or CSV messages)")
    p.add_argument("--servers")
    p.add_argument("--topic")
    p.add_argument("--format", choices=["json", "csv"], default="json")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--store", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--trigger-seconds", type=float, default=5.0)
    p.add_argument("--max-batches", type=int)
    p.add_argument("--idle-seconds", type=float)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--dedup-delay", help='drop repeated event ids within this delay, e.g. "1 hour"')
    p.add_argument("--jdbc-url")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    a = arguments(argv)
    spark = get_session()
    source = SourceSpec(kind="files" if a.path else "kafka", path=a.path, servers=a.servers, topic=a.topic,
                        starting_offsets=a.starting_offsets, value_format=a.format)
    limits = RunLimits(a.available_now, a.trigger_seconds, a.max_batches, a.idle_seconds)
    if a.job == "events":
        tables = run_event_job(spark, source, a.store, a.checkpoint, limits, a.dedup_delay)
    else:
        tables = run_segment_job(spark, source, a.store, a.checkpoint, limits, a.jdbc_url)
    for name, table in tables.items():
        print(name)
        table.show(truncate=False)


if __name__ == "__main__":
    main()
