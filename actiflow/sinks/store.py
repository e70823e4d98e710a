"""Result store: named Parquet tables under one shared root.

Two kinds of table:

* **Facts by version.** Rows of a micro-batch go to the partition of their version: the
  ``generation`` (one per streaming checkpoint) and the ``epoch`` within it. Writes replace
  whole partitions (dynamic partition overwrite), never append: a micro-batch that is
  replayed after a failure rewrites the same partitions with the same rows, so at-least-once
  delivery gives exactly-once results. A query that starts on a new checkpoint counts epochs
  from 0 again; it gets a generation of its own and replaces nothing of an earlier one.
* **Snapshots.** Every write is a folder of its own; a pointer row, written last, names it.
  Readers follow the newest pointer, so they see the old snapshot or the new one, whole, also
  while a write runs and after one that failed.

Parquet (not CSV) keeps the declared types and lets readers prune partitions and push
filters down.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiflow.sinks.files import delete

#: Partition columns of a fact table, in order of version.
VERSION = ["generation", "epoch"]
VERSION_FIELDS = [T.StructField("generation", T.StringType()), T.StructField("epoch", T.LongType())]
#: Generation of rows written without a checkpoint (batch jobs, tests); before all others.
NO_CHECKPOINT = "000000-none"

_POINTER = T.StructType([T.StructField("ordinal", T.LongType()), T.StructField("note", T.StringType()),
                         T.StructField("folder", T.StringType())])
_GENERATIONS = T.StructType([T.StructField("ordinal", T.LongType()), T.StructField("query_id", T.StringType())])


def version() -> Column:
    """Orderable version of a row."""
    return F.struct(*VERSION)


class ResultStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    # --- facts ------------------------------------------------------------------
    def write_partitions(self, df: DataFrame, name: str, partition_by: list[str]) -> None:
        """Replace exactly the partitions present in ``df`` (idempotent on replay)."""
        (df.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by)
         .parquet(self.path(name)))

    def write_version(self, df: DataFrame, name: str, generation: str, epoch: int) -> None:
        """Replace the rows of one version."""
        self.write_partitions(df.withColumn("generation", F.lit(generation))
                              .withColumn("epoch", F.lit(int(epoch)).cast("long")), name, VERSION)

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """Stored table; a table never written reads as empty (with ``schema``)."""
        return self._read(self.path(name), schema)

    def _read(self, path: str, schema: T.StructType | None) -> DataFrame:
        try:
            reader = self.spark.read
            if schema is not None:
                reader = reader.schema(schema)
            return reader.parquet(path)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc) and "UNABLE_TO_INFER_SCHEMA" not in str(exc):
                raise
            if schema is None:
                raise
            return self.spark.createDataFrame([], schema)

    # --- generations ------------------------------------------------------------
    def generation(self, checkpoint: str | None) -> str:
        """The generation of a streaming checkpoint: its place among the store's checkpoints
        and the id Spark gave its query. Started anew on an old checkpoint, a query keeps it."""
        if checkpoint is None:
            return NO_CHECKPOINT
        query_id = query_id_of(self.spark, checkpoint)
        known = self.read("generations", _GENERATIONS)
        own = known.filter(F.col("query_id") == query_id).agg(F.min("ordinal")).first()[0]
        if own is None:
            own = (known.agg(F.max("ordinal")).first()[0] or 0) + 1
            # A folder of its own: writers of one folder would remove each other's working files.
            row = self.spark.createDataFrame([(own,)], _GENERATIONS[:1])
            row.coalesce(1).write.mode("overwrite").parquet(f"{self.path('generations')}/query_id={query_id}")
        # The id keeps two queries apart that register at the same time.
        return f"{own:06d}-{query_id}"

    # --- snapshots --------------------------------------------------------------
    def write_snapshot(self, df: DataFrame, name: str, note: str | None = None) -> None:
        """Replace the whole table; readers change over when it is complete."""
        folder = uuid.uuid4().hex
        df.write.parquet(f"{self.path(name)}/versions/{folder}")
        now = self._pointer(name)
        row = self.spark.createDataFrame([(now["ordinal"] + 1 if now else 1, note)],
                                         T.StructType([_POINTER["ordinal"], _POINTER["note"]]))
        row.coalesce(1).write.parquet(f"{self.path(name)}/pointer/folder={folder}")

    def _pointer(self, name: str):
        rows = self._read(f"{self.path(name)}/pointer", _POINTER)
        return rows.agg(F.max(F.struct("ordinal", "folder", "note")).alias("p")).first()["p"]

    def read_snapshot(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The newest complete snapshot; a table never written reads as empty (with ``schema``)."""
        now = self._pointer(name)
        if now is None:
            if schema is None:
                raise FileNotFoundError(f"no snapshot of {name} in {self.root}")
            return self.spark.createDataFrame([], schema)
        return self._read(f"{self.path(name)}/versions/{now['folder']}", schema)

    def snapshot_note(self, name: str) -> str | None:
        now = self._pointer(name)
        return now["note"] if now else None

    def expire_snapshots(self, name: str, keep: int = 2) -> int:
        """Delete the folders of all but the newest ``keep`` snapshots (those that readers may
        still hold open); returns how many."""
        if keep < 1:
            raise ValueError("the newest snapshot is in use")
        rows = self._read(f"{self.path(name)}/pointer", _POINTER).orderBy(F.desc("ordinal"), F.desc("folder")).collect()
        return sum(delete(self.spark, f"{self.path(name)}/versions/{r['folder']}") for r in rows[keep:])


def query_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint's metadata file (there before the first batch)."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


# --- compaction -----------------------------------------------------------------
def _covered(store: ResultStore, name: str) -> dict[str, int]:
    """generation -> last epoch that the newest compaction holds."""
    return compaction_note(store, name).get("cover", {})


def compaction_note(store: ResultStore, name: str) -> dict:
    """What the pointer row of the newest compaction says: its cover, and the totals given."""
    return json.loads(store.snapshot_note(name + "_compacted") or "{}")


def _within(cover: dict[str, int]) -> Column:
    """Rows of covered versions. Literals, so that partitions are pruned; one condition for
    each generation, that is, for each checkpoint the store has seen."""
    return reduce(lambda a, b: a | b, [(F.col("generation") == g) & (F.col("epoch") <= e) for g, e in cover.items()],
                  F.lit(False))


def tail_rows(store: ResultStore, name: str, schema: T.StructType) -> DataFrame:
    """Stored rows that the newest compaction does not hold."""
    rows = store.read(name, schema)
    cover = _covered(store, name)
    return rows.filter(~_within(cover)) if cover else rows


def compacted_rows(store: ResultStore, name: str, schema: T.StructType) -> DataFrame:
    """Rows of a fact table: its newest compaction and all versions after it."""
    return tail_rows(store, name, schema).unionByName(store.read_snapshot(name + "_compacted", schema))


def compact(store: ResultStore, name: str, schema: T.StructType, keep_epochs: int,
            merge: Callable[[DataFrame], DataFrame],
            totals: Callable[[DataFrame], dict] = lambda rows: {}) -> dict[str, int]:
    """Store ``merge`` of all but the newest ``keep_epochs`` epochs of every generation as a
    new compaction; returns what it covers. ``merge`` may add columns; ``totals`` of the
    merged rows (a few numbers) become part of the pointer row.

    A compaction is a snapshot: its cover is part of the pointer row, so readers see the old
    one or the new one, with the right rest of the versions. Only a generation's newest epoch
    can be replayed, which ``keep_epochs`` of 1 leaves out.
    """
    if keep_epochs < 1:
        raise ValueError("the newest epoch may be replayed and cannot be compacted")
    before = _covered(store, name)
    newest = {r["generation"]: r["epoch"] for r in store.read(name, schema).groupBy("generation")
              .agg(F.max("epoch").alias("epoch")).collect()}  # a row per checkpoint
    cover = dict(before)
    for generation, epoch in newest.items():
        if epoch - keep_epochs > before.get(generation, -1):
            cover[generation] = epoch - keep_epochs
    if cover == before:
        return cover
    old = tail_rows(store, name, schema).filter(_within(cover)).unionByName(
        store.read_snapshot(name + "_compacted", schema))
    merged = merge(old)
    store.write_snapshot(merged, name + "_compacted", json.dumps({"cover": cover} | totals(merged), sort_keys=True))
    return cover
