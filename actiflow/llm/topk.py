"""Exact top-k inner products by block-at-a-time pruning.

Vectors become integers and are stored in blocks of consecutive ids: a forward index (the
block's vectors as one matrix) with the largest and smallest value of every dimension.
For a query, the sum over its dimensions of weight times the block's largest value (the
smallest, where the weight is negative) bounds every score in the block. Blocks are taken
in falling order of that bound and scored through their matrix until the bound falls below
the query's k-th score; blocks at an equal bound are scored, since ties go to the smaller id.

Blocks are dealt out as segments and queries as groups, both of bounded size; one task
holds one group and one segment. A first pass over one segment gives every query its k-th
score to start with. For all other segments a group first meets the blocks' largest and
smallest values alone; only blocks that some query's bound still reaches are sent to it.

Defined cases: vectors that are null or hold null or non-finite components, and rows
without an id, take no part; missing dimensions count as zero; rows with one id are rows of
their own, each a candidate of the others (and each a query, where the id asks for it);
values beyond 64 bits stop at that limit; fewer than k candidates give fewer rows; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from actiflow.llm.common import in_arrow, stored
from actiflow.sources.tables import read_table

# Fixed values of the contract.
SCALE = 256
TOP = 5
QUERY_EVERY = 50
# Method parameters: vectors in a block, blocks in a segment, queries in a group.
BLOCK = 256
SEGMENT_BLOCKS = 64
GROUP = 4096

LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
PACKED = ("part BIGINT, block BIGINT, ids BINARY, nrs BINARY, width INT, size INT, matrix BINARY, "
          "high BINARY, low BINARY")


def integers(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, nr, v): usable vectors as integers; ``nr`` tells rows apart once it is stored."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return (table.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad)
            .select(F.col(id_col).cast("bigint").alias("id"), F.monotonically_increasing_id().alias("nr"),
                    F.transform(vector_col, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint")).alias("v")))


def item_size(matrix: np.ndarray) -> int:
    """Bytes of the smallest integers that hold the matrix."""
    low, high = int(matrix.min(initial=0)), int(matrix.max(initial=0))
    return next(n for n in (2, 4, 8) if -(1 << 8 * n - 1) <= low and high < 1 << 8 * n - 1)


def packed(rows: DataFrame, size: int, per_part: int) -> DataFrame:
    """Rows of up to ``size`` vectors next to each other by id, with the largest and smallest
    value of every dimension; ``part`` numbers runs of ``per_part`` rows."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, ids, nrs, vectors = TaskContext.get().partitionId(), 0, [], [], []

        def row():
            width = max(map(len, vectors))
            matrix = np.zeros((len(vectors), width), np.int64)
            for i, v in enumerate(vectors):
                matrix[i, :len(v)] = v
            bytes_each = item_size(matrix)
            small = f"<i{bytes_each}"
            values = [(task << 32) + made // per_part, (task << 32) + made, np.array(ids, "<i8").tobytes(),
                      np.array(nrs, "<i8").tobytes(), width, bytes_each, matrix.astype(small).tobytes(),
                      matrix.max(axis=0).astype(small).tobytes(), matrix.min(axis=0).astype(small).tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(values, (
                    pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), *[pa.binary()] * 3))],
                names=["part", "block", "ids", "nrs", "width", "size", "matrix", "high", "low"])

        for batch in batches:
            for i, nr, v in zip(*(c.to_pylist() for c in batch.columns)):
                ids.append(i)
                nrs.append(nr)
                vectors.append(v)
                if len(ids) == size:
                    yield row()
                    made, ids, nrs, vectors = made + 1, [], [], []
        if ids:
            yield row()

    return in_arrow(rows.repartitionByRange(n, "id", "nr").sortWithinPartitions("id", "nr"), pack, PACKED)


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, row numbers and matrix of a packed row."""
    ids, nrs = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["nrs"], "<i8")
    return ids, nrs, np.frombuffer(row["matrix"], f"<i{row['size']}").astype(np.int64).reshape(len(ids), row["width"])


def padded(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T of integer matrices."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = int(np.abs(a.astype(np.float64)).max()) * int(np.abs(b.astype(np.float64)).max()) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, LOWEST, HIGHEST).astype(np.int64)


def upper_bounds(queries: np.ndarray, highs: np.ndarray, lows: np.ndarray) -> np.ndarray:
    """Bound of every query's scores in every block, from the blocks' extremes; sums beyond
    64 bits stop at that limit."""
    a, b = products(np.maximum(queries, 0), highs), products(np.minimum(queries, 0), lows)
    total = a + b
    total[(a > 0) & (b > 0) & (total < 0)] = HIGHEST
    total[(a < 0) & (b < 0) & (total >= 0)] = LOWEST
    return total


def search(query_nrs: np.ndarray, queries: np.ndarray, floors: np.ndarray,
           blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row of the query, id, score) of the best k of each query in these blocks, leaving
    out scores below its floor, and the number of products made."""
    width = max([queries.shape[1], *(b.shape[1] for _, _, b in blocks)])
    queries = padded(queries, width)
    blocks = [(ids, nrs, padded(b, width)) for ids, nrs, b in blocks]
    bounds = upper_bounds(queries, np.array([b.max(axis=0) for *_, b in blocks]),
                          np.array([b.min(axis=0) for *_, b in blocks]))
    order = np.argsort(-bounds, axis=1, kind="stable")
    best = [np.zeros(0, np.int64)] * 3  # row, id, score of the best so far, by row
    kth = floors.copy()
    active, made = np.arange(len(queries)), 0
    for step in range(len(blocks)):
        block = order[active, step]
        alive = bounds[active, block] >= kth[active]
        active, block = active[alive], block[alive]
        if not len(active):
            break
        found = [best]
        for at in np.unique(block):
            rows, (ids, nrs, matrix) = active[block == at], blocks[at]
            scores = products(queries[rows], matrix)
            made += scores.size
            r, c = np.nonzero((scores >= kth[rows][:, None]) & (nrs[None, :] != query_nrs[rows][:, None]))
            found.append([rows[r], ids[c], scores[r, c]])
        row, ids, score = (np.concatenate(x) for x in zip(*found))
        by = np.lexsort((ids, -score, row))
        row, ids, score = row[by], ids[by], score[by]
        first = np.concatenate(([0], np.nonzero(np.diff(row))[0] + 1)) if len(row) else np.zeros(0, int)
        place = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        last = place == k - 1
        kth[row[last]] = np.maximum(kth[row[last]], score[last])
        best = [x[place < k] for x in (row, ids, score)]
    return *best, made


FOUND = "grp BIGINT, floors BINARY, query_ids BINARY, query_nrs BINARY, ids BINARY, scores BINARY"


def searched(groups: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Search every (group, segment) cell. ``groups``: grp, segment and the packed queries
    with their floors; ``blocks``: the same as of and at, and the packed blocks."""
    def cell(left, right):
        out = {n: [] for n in ("grp", "floors", "query_ids", "query_nrs", "ids", "scores")}
        blocks = [unpack(r) for r in right.to_pylist()]
        for q in left.to_pylist():
            ids, nrs, queries = unpack(q)
            floors = np.frombuffer(q["floors"], "<i8") if q["floors"] else np.full(len(ids), LOWEST)
            row, near, score, _ = search(nrs, queries, floors, blocks, k) if blocks else [np.zeros(0, np.int64)] * 3 + [0]
            kth = floors.copy()
            if len(row):
                _, first, n = np.unique(row, return_index=True, return_counts=True)
                full = first[n == k]
                kth[row[full]] = np.maximum(kth[row[full]], score[full + k - 1])
            for name, value in zip(out, (q["grp"], *(x.astype("<i8").tobytes()
                                                     for x in (kth, ids[row], nrs[row], near, score)))):
                out[name].append(value)
        return pa.table({n: pa.array(v, pa.int64() if n == "grp" else pa.binary()) for n, v in out.items()})

    return groups.groupBy("grp", "segment").cogroup(blocks.groupBy("of", "at")).applyInArrow(cell, FOUND)


def reached(groups: DataFrame, extremes: DataFrame) -> DataFrame:
    """(grp, block): the blocks that the bound of some query of the group still reaches.
    ``extremes``: of, at, block, width, size, high, low."""
    def cell(left, right):
        out = {"grp": [], "block": []}
        rows = right.to_pylist()
        for q in left.to_pylist() if rows else []:
            _, _, queries = unpack(q)
            floors = np.frombuffer(q["floors"], "<i8")
            width = max([queries.shape[1], *(r["width"] for r in rows)])
            highs, lows = (np.concatenate([padded(np.frombuffer(r[c], f"<i{r['size']}").astype(np.int64)[None], width)
                                           for r in rows]) for c in ("high", "low"))
            bounds = upper_bounds(padded(queries, width), highs, lows)
            for at in np.nonzero((bounds >= floors[:, None]).any(axis=0))[0]:
                out["grp"].append(q["grp"])
                out["block"].append(rows[at]["block"])
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    return groups.groupBy("grp", "segment").cogroup(extremes.groupBy("of", "at")).applyInArrow(
        cell, "grp BIGINT, block BIGINT")


def top_k(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = TOP,
          query_every: int = QUERY_EVERY, block: int = BLOCK, segment_blocks: int = SEGMENT_BLOCKS,
          group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by
    ``query_every``, its best k among all others."""
    rows = stored(integers(table, id_col, vector_col), "topk_vectors")
    blocks = stored(packed(rows, block, segment_blocks).withColumnRenamed("part", "segment"), "topk_blocks")
    queries = stored(packed(rows.filter(F.col("id") % query_every == 0), group, 1)
                     .withColumnRenamed("part", "grp"), "topk_queries").drop("block", "high", "low")
    # The grid of groups and segments: every group meets every segment, over shards of
    # segment numbers, so that neither list is gathered in one place.
    segments = blocks.select("segment").distinct()
    shards = max(1, segments.count() // 64)
    dealt = segments.withColumn("shard", F.pmod(F.xxhash64("segment"), F.lit(shards)).cast("int"))
    grid = (queries.select("grp").distinct()
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
            .join(dealt, "shard").select("grp", "segment"))
    seeds = grid.groupBy("grp").agg(F.min_by("segment", F.xxhash64("segment", "grp")).alias("seed"))
    grid = stored(grid.join(seeds, "grp"), "topk_grid")
    place = [F.col("grp").alias("of"), F.col("segment").alias("at")]

    def asked(cells: DataFrame, floors: DataFrame) -> DataFrame:
        return cells.select("grp", "segment").join(queries, "grp").join(floors, "grp", "left")

    none = queries.select("grp", F.lit(None).cast("binary").alias("floors"))
    seed = grid.filter("segment = seed")
    matrices = blocks.drop("high", "low")
    first = stored(searched(asked(seed, none), seed.join(matrices, "segment").select(
        *place, "ids", "nrs", "width", "size", "matrix"), k), "topk_first")
    floors = first.select("grp", "floors")
    rest = grid.filter("segment <> seed").select("grp", "segment")
    extremes = rest.join(blocks.drop("ids", "nrs", "matrix"), "segment").select(
        *place, "block", "width", "size", "high", "low")
    kept = stored(reached(asked(rest, floors), extremes), "topk_reached").join(matrices, "block")
    cells = kept.select("grp", "segment").distinct()
    second = searched(asked(cells, floors), kept.select(*place, "ids", "nrs", "width", "size", "matrix"), k)

    def unpacked(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.frombuffer(x.as_py(), "<i8") for x in c]), pa.int64())
                 for c in batch.columns], names=["query_id", "nr", "vec_id", "score"])

    found = first.select("query_ids", "query_nrs", "ids", "scores").union(
        second.select("query_ids", "query_nrs", "ids", "scores"))
    found = in_arrow(found, unpacked, "query_id BIGINT, nr BIGINT, vec_id BIGINT, score BIGINT")
    rank = F.row_number().over(Window.partitionBy("query_id", "nr").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"))


OP3_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS nr, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, q.nr, d.vec_id, list_dot_product(q.e, d.e)::BIGINT AS score
  FROM v q JOIN v d ON q.nr <> d.nr WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY nr ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
WHERE rank <= 5
"""
