"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``VIRTUAL`` points (virtual nodes) on a ring of hash values. A row's key
hashes to a place on the ring and asks the shard of the next point clockwise; when that
shard is full, the row goes on to the next point, and so on. With capacities that add up to
the number of rows the shards end up exactly balanced; with ``slack`` they hold up to that
share more than the mean and fewer rows move when a shard is added.

The ring has a bounded number of arcs (shards times virtual nodes), so the walk is done on
their row counts: in step t the rows left on every arc ask the point t places on, and a full
shard turns away the arcs that come later clockwise. What an arc gives to a shard is a run of
consecutive rows of the arc (in hash order), hence a bounded table of runs; a row's number in
ring order then tells its shard and its slot. Rows are numbered by range-sorted partitions,
so a key or an arc with a third of all rows is split over tasks.

Law: ``rows`` (counts of any two shards differ by one at most). Loads depend on all rows, so
a shard is no function of the key alone and ``grown_shard`` is null. Equal texts are no unit
here: rows hash by their own id.

Defined cases: null text has size 8 and the checksum of no bytes; rows without an id hash by
their text; rows with one id share a place on the ring and are told apart by their text;
fewer rows than shards leave shards empty; an empty table gives an empty result; extra
columns stay (those named like a result are replaced).
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actiflow.llm.common import PREFIX, text_bytes, without
from actiflow.llm.ordering import numbered
from actiflow.sources.tables import read_table

# Fixed values of the contract.
SHARDS = 24
ROW_BYTES = 8
LAW = "rows"
# Method parameters: points of a shard; the ring has 2 ** CELL_BITS places for points.
VIRTUAL = 128
CELL_BITS = 16


def points(shards: int, virtual: int) -> list[tuple[int, int]]:
    """(cell, shard) of all virtual nodes clockwise. A shard's points do not depend on the
    number of shards."""
    def digest(shard: int, node: int) -> int:
        return int.from_bytes(hashlib.md5(f"{shard}:{node}".encode()).digest()[:8], "big")
    nodes = sorted((digest(s, v), s) for s in range(shards) for v in range(virtual))
    return [(place >> (64 - CELL_BITS), s) for place, s in nodes]


def arcs_of_cells(nodes: list[tuple[int, int]]) -> np.ndarray:
    """The arc of every cell: the number of the first point at or after it, clockwise."""
    cells = np.array([c for c, _ in nodes])
    return np.searchsorted(cells, np.arange(1 << CELL_BITS)) % len(nodes)


def capacities(rows: int, shards: int, slack: float) -> np.ndarray:
    """Without slack, the capacities add up to the rows and differ by one at most."""
    if slack <= 0:
        return np.array([rows // shards + (s < rows % shards) for s in range(shards)], np.int64)
    return np.full(shards, -int(-(1 + slack) * rows // shards), np.int64)


def runs(counts: np.ndarray, owners: np.ndarray, room: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(arc, first, end, shard, slot): rows first..end-1 of the arc go to consecutive slots."""
    counts, room = counts.astype(np.int64), room.copy()
    given = np.zeros_like(counts)
    load = np.zeros_like(room)
    out = []
    for step in range(len(owners)):
        arcs = np.nonzero(counts > given)[0]
        if not len(arcs):
            break
        shard = owners[(arcs + step) % len(owners)]
        order = np.argsort(shard, kind="stable")
        arcs, shard = arcs[order], shard[order]
        asked = counts[arcs] - given[arcs]
        ahead = np.cumsum(asked) - asked
        first = np.searchsorted(shard, shard)  # the first arc that asks the same shard
        ahead -= ahead[first]
        taken = np.clip(room[shard] - ahead, 0, asked)
        for a, s, n, before in zip(arcs, shard, taken, ahead):
            if n:
                out.append((int(a), int(given[a]), int(given[a] + n), int(s), int(load[s] + before)))
        given[arcs] += taken
        np.subtract.at(room, shard, taken)
        np.add.at(load, shard, taken)
    return out


def place(docs: DataFrame, key: Column, tie: Column, shards: int = SHARDS, virtual: int = VIRTUAL,
          slack: float = 0.0) -> DataFrame:
    """Adds shard and slot. ``key`` decides the place on the ring, ``tie`` the order of rows
    with equal keys."""
    spark = docs.sparkSession
    nodes = points(shards, virtual)
    names = {x: PREFIX + x for x in ("cell", "of", "arc", "at", "tie", "id", "number", "lo", "hi", "run", "from")}
    # At most 2 ** CELL_BITS rows.
    cells = spark.createDataFrame([(c, int(a)) for c, a in enumerate(arcs_of_cells(nodes))],
                                  f"{names['of']} INT, {names['arc']} INT")
    base = (without(docs, "shard", "slot")
            .withColumn(names["at"], F.xxhash64(key)).withColumn(names["tie"], F.xxhash64(tie))
            .withColumn(names["id"], F.monotonically_increasing_id())
            .withColumn(names["cell"], F.shiftrightunsigned(names["at"], 64 - CELL_BITS).cast("int")))
    onto = base.join(F.broadcast(cells), F.col(names["cell"]) == F.col(names["of"])).drop(names["cell"], names["of"])
    order = [F.col(names[x]) for x in ("arc", "at", "tie", "id")]
    # Narrow enough to be sorted; its checkpoint also serves the counts.
    rows = numbered(onto, order, names["number"])
    counts = np.zeros(len(nodes), np.int64)
    for r in rows.groupBy(names["arc"]).agg(F.count(F.lit(1)).alias("n")).collect():  # a row per arc
        counts[r[0]] = r["n"]
    starts = np.cumsum(counts) - counts
    owners = np.array([s for _, s in nodes])
    table = [(a, int(starts[a]) + lo, int(starts[a]) + hi, s, slot) for a, lo, hi, s, slot in
             runs(counts, owners, capacities(int(counts.sum()), shards, slack))]
    # At most arcs times shards rows, about one per arc.
    given = spark.createDataFrame(table, f"{names['run']} INT, {names['lo']} BIGINT, {names['hi']} BIGINT, "
                                         f"shard INT, {names['from']} BIGINT")
    inside = ((F.col(names["arc"]) == F.col(names["run"])) & (F.col(names["number"]) >= F.col(names["lo"]))
              & (F.col(names["number"]) < F.col(names["hi"])))
    return (rows.join(F.broadcast(given), inside)
            .withColumn("slot", F.col(names["from"]) + F.col(names["number"]) - F.col(names["lo"]))
            .drop(*names.values()))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
          virtual: int = VIRTUAL, slack: float = 0.0, keep_text: bool = True) -> DataFrame:
    """Documents with size, text_crc32, law, shard, slot and grown_shard."""
    data = text_bytes(text_col)
    own = without(docs, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    sized = own.withColumn("size", (F.octet_length(data) + ROW_BYTES).cast("bigint")).withColumn(
        "text_crc32", F.crc32(data))
    if not keep_text:  # texts are then read once and never moved
        sized = sized.drop(text_col)
    by_text = F.concat_ws(":", F.lit("text"), F.col("text_crc32"), F.col("size"))
    placed = place(sized, F.coalesce(F.col(id_col).cast("string"), by_text), by_text, shards, virtual, slack)
    law = LAW if slack <= 0 else None
    return placed.withColumn("law", F.lit(law).cast("string")).withColumn("grown_shard", F.lit(None).cast("int"))


def op11_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard(docs, keep_text=False).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
