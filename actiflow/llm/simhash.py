"""SimHash near-duplicates with pivot distance tables.

1. Fingerprint: every 4-word shingle of the lower-cased text gives an XXH64 value; a bit
   of the fingerprint is set when it is set in over half of them. Equal fingerprints are
   one from here on, however many documents share them.
2. Groups: two fingerprints within ``max_bits`` agree on at least two of ``max_bits + 2``
   bit blocks, so one row per pair of blocks, keyed by the bits of both, brings every
   linked pair together at least once. A group larger than ``CHUNK`` is dealt out as
   pairs of its chunks, so no task holds more than two chunks of a group.
3. Pivot table: within a group, every fingerprint has its Hamming distances to many fixed
   reference fingerprints. By the triangle inequality a pair whose distances to any one
   reference differ by more than ``max_bits`` cannot link; only pairs whose largest
   difference stays within the limit are compared bit by bit.
4. Each task returns a spanning forest of its links, not all of them; components of these
   links are the classes.

Defined cases: null text counts as empty; fewer than 4 words give one shingle of all of
them, none gives fingerprint zero, linked like any other; repeated rows and equal texts
share a class; a null doc_id is kept as null and never names a class unless its class has
no other id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiflow.llm.common import PREFIX, in_arrow, map_arrow, map_groups, stored, text_bytes
from actiflow.llm.components import Forest, connected_components
from actiflow.sources.tables import read_table

# Fixed values of the contract.
SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
# Method parameters: reference fingerprints, their seed, and rows of a group in one chunk.
N_PIVOTS = 24
PIVOT_SEED = 2024
CHUNK = 2048


def shingle_hashes(data: bytes, width: int = SHINGLE_WORDS) -> np.ndarray:
    words = data.lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if n <= width:
        return np.array([xxhash.xxh64_intdigest(joined, HASH_SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], HASH_SEED)
                        for a, b in zip(starts[:n - width + 1].tolist(), ends[width - 1:].tolist())),
                       dtype=np.uint64, count=n - width + 1)


def bit_counts(values: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits (highest first) is set."""
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 1 << 16):
        rows = values[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(rows, axis=1)
        # Byte sums of up to 255 rows cannot overflow, so eight columns add as one integer.
        packed = np.add.reduceat(bits.view(np.uint64), np.arange(0, len(bits), 255), axis=0)
        total += packed.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(data: bytes, width: int = SHINGLE_WORDS) -> int:
    values = shingle_hashes(data, width)
    if not len(values):
        return 0
    return int.from_bytes(np.packbits(2 * bit_counts(values) > len(values)).tobytes(), "big")


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer, one row per input row."""
    work = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("data"))

    def make():
        def each(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column(0),
                    "fp": [signed(fingerprint(x.as_py(), shingle_words)) for x in batch.column(1)]}
        return each

    return map_arrow(work, make, "doc_id BIGINT, fp BIGINT")


def with_fingerprint(docs: DataFrame, text_col: str, shingle_words: int) -> DataFrame:
    """The rows with the fingerprint of their text beside their own columns."""
    at = len(docs.columns)
    schema = T.StructType(docs.schema.fields + [T.StructField(PREFIX + "fp", T.LongType())])

    def run(batches):
        for batch in batches:
            prints = [signed(fingerprint(x.as_py(), shingle_words)) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(prints, pa.int64())], names=schema.fieldNames())

    return in_arrow(docs.withColumn(PREFIX + "data", text_bytes(text_col)), run, schema)


def block_masks(max_bits: int) -> list[int]:
    """Bit masks of all pairs of ``max_bits + 2`` blocks of the 64 bits."""
    blocks = np.array_split(np.arange(64), max_bits + 2)
    single = [sum(1 << int(b) for b in block) for block in blocks]
    return [a | b for a, b in combinations(single, 2)]


def pivots(n: int = N_PIVOTS, seed: int = PIVOT_SEED) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, dtype=np.uint64,
                                                              endpoint=False)


def pivot_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distances, one row per fingerprint and one column per reference."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def survivors(i: np.ndarray, j: np.ndarray, a: np.ndarray, b: np.ndarray, left: np.ndarray,
              right: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the index pairs (i in left, j in right), those within ``max_bits``: the pivot
    tables a and b discard by the largest coordinate difference, the rest is verified."""
    for p in range(a.shape[1]):
        ok = np.abs(a[i, p] - b[j, p]) <= max_bits
        i, j = i[ok], j[ok]
    ok = np.bitwise_count(left[i] ^ right[j]) <= max_bits
    return i[ok], j[ok]


def pairs_between(left: np.ndarray, right: np.ndarray, max_bits: int, refs: np.ndarray,
                  same: bool, step: int = 256):
    """Linked index pairs of two chunks, in blocks of rows. With ``same``, left is right
    and only i < j counts."""
    a, b = pivot_table(left, refs), pivot_table(right, refs)
    for at in range(0, len(left), step):
        rows = a[at:at + step]
        alive = np.abs(rows[:, None, 0] - b[None, :, 0]) <= max_bits
        if same:
            alive &= np.arange(len(b))[None, :] > np.arange(at, at + len(rows))[:, None]
        i, j = np.nonzero(alive)
        yield survivors(at + i, j, a, b, left, right, max_bits)


def pairs_of_small(fps: np.ndarray, group: np.ndarray, largest: int, max_bits: int, refs: np.ndarray):
    """Linked index pairs within many small groups at once (rows sorted by group)."""
    table = pivot_table(fps, refs)
    for shift in range(1, largest):
        i = np.nonzero(group[shift:] == group[:-shift])[0]
        yield survivors(i, i + shift, table, table, fps, fps, max_bits)


def cell_links(fps: np.ndarray, chunk: np.ndarray, c1: np.ndarray, c2: np.ndarray,
               bounds: np.ndarray, max_bits: int, refs: np.ndarray,
               small: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within each cell; rows lie cell after cell."""
    sizes = np.diff(bounds)
    cell = np.repeat(np.arange(len(sizes)), sizes)
    forest, left, right = Forest(len(fps)), [], []

    def add(i, j):
        for x, y in zip(i.tolist(), j.tolist()):
            if forest.union(x, y):
                left.append(x)
                right.append(y)

    first = bounds[:-1]
    few = (sizes <= small) & (c1[first] == c2[first])
    rows = np.nonzero(few[cell])[0]
    if len(rows):
        for i, j in pairs_of_small(fps[rows], cell[rows], int(sizes[few].max()), max_bits, refs):
            add(rows[i], rows[j])
    for k in np.nonzero(~few)[0].tolist():
        at = np.arange(bounds[k], bounds[k + 1])
        one, two = at[chunk[at] == c1[at]], at[chunk[at] == c2[at]]
        for i, j in pairs_between(fps[one], fps[two], max_bits, refs, c1[at[0]] == c2[at[0]]):
            add(one[i], two[j])
    return fps[np.array(left, dtype=np.int64)], fps[np.array(right, dtype=np.int64)]


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK,
                      n_pivots: int = N_PIVOTS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``max_bits``.

    ``distinct``: one row per fingerprint, column fp (a stored table: it is read twice).
    """
    masks = block_masks(max_bits)
    keyed = distinct.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks])).alias("band", "bits"))
    # Only groups of two or more matter; large ones are dealt out by pairs of chunks.
    sizes = keyed.groupBy("band", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / chunk).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    grouped = (keyed.join(sizes.withColumn("parts", parts).drop("n"), ["band", "bits"])
               .withColumn("chunk", mine)
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
               .select("band", "bits", F.least("chunk", "other").alias("c1"),
                       F.greatest("chunk", "other").alias("c2"), "chunk", "fp"))
    refs = pivots(n_pivots)

    def make():
        def each(table: pa.Table, bounds: np.ndarray) -> dict:
            cols = {c: table.column(c).to_numpy() for c in ("fp", "chunk", "c1", "c2")}
            a, b = cell_links(cols["fp"].view(np.uint64), cols["chunk"], cols["c1"], cols["c2"],
                              bounds, max_bits, refs)
            return {"a": a.view(np.int64), "b": b.view(np.int64)}
        return each

    return map_groups(grouped, ["band", "bits", "c1", "c2"], make, "a BIGINT, b BIGINT")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (signed 64-bit), class_fp (names the class by a fingerprint of it) and
    component_id (smallest doc_id of the class)."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle_words), "simhash_prints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash_classes")
    links = stored(fingerprint_links(classes.select("fp"), max_bits), "simhash_links")
    parts = connected_components(links)
    # The class is named by the smallest doc_id among all its fingerprints.
    rooted = classes.join(parts, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(names, "root").select(
        F.col("fp").alias(PREFIX + "fp"), F.col("root").alias("class_fp"), "component_id")
    return prints.join(named, F.col("fp") == F.col(PREFIX + "fp")).select(
        "doc_id", "fp", "class_fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each class: the one with the smallest id, the others go.

    Rows that share their id with others (repeated rows, null ids) are told apart by
    their fingerprint, so they too leave exactly one row per class.
    """
    found = stored(near_duplicates(docs, id_col, text_col, shingle_words, max_bits), "simhash_found")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = stored(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(first).alias("first"))
                 .filter("first").select(F.col("doc_id").alias(PREFIX + "doc"),
                                         (F.col("doc_id").isNotNull() & (F.col("n") == 1)).alias("single")),
                 "simhash_keep")
    same_id = F.col(id_col).cast("bigint").eqNullSafe(F.col(PREFIX + "doc"))
    # The list of kept ids grows with the documents: the same join at every size.
    kept = docs.join(ids.filter("single").drop("single").hint("merge"), same_id, "left_semi")
    shared = ids.filter("NOT single").drop("single")
    if shared.isEmpty():
        return kept
    rows = with_fingerprint(docs.join(shared, same_id, "left_semi"), text_col, shingle_words)
    classes = found.filter(first).select(
        F.col("doc_id").alias(PREFIX + "doc"), F.col("fp").alias(PREFIX + "of"),
        F.col("class_fp").alias(PREFIX + "class")).distinct()
    chosen = rows.join(classes, same_id & (F.col(PREFIX + "fp") == F.col(PREFIX + "of")))
    return kept.union(chosen.dropDuplicates([PREFIX + "class"]).select(*docs.columns))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
