"""Substring dedup by paragraph MinHash banding.

1. A paragraph is a line of at least ``min_words`` words; its words are lower-cased. Equal
   word sequences are one text from here on (64-bit hash), however often they occur.
2. MinHash over 5-word shingles, cut into bands of ``rows`` minima each; the number of
   bands is the least that finds a pair at the threshold with probability ``recall``.
3. Texts that collide in a band are joined. Nobody emits all pairs of a bucket: in each of
   a few rounds every text is verified against one pivot of its bucket, and buckets whose
   texts are all connected drop out. What is left is compared block by block: texts outside
   a bucket's largest component against all others, in chunks of bounded size.
4. Verification is exact Jaccard of the shingle sets (64-bit shingle hashes), and
   ``similarity`` or more links. Components of the links are the classes; within a class
   all occurrences but the first (smallest doc_id, then paragraph) are removals.
5. Passages inside longer lines, or across short ones, are paragraphs cut by content (see
   ``embedded``): those that repeat outside the lines found so far are classes, too.
6. An occurrence is named by doc_id and text hash, rows without doc_id by a number too.

Defined cases: null or empty text has no paragraphs; a null doc_id comes after all others,
and each such row is a document of its own; different texts under one doc_id are different
documents; rows equal in doc_id and text count as occurrences and share their verdicts; paragraphs below the length are never duplicates; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actiflow.llm import embedded, runs
from actiflow.llm.common import CONTINUATION, map_arrow, map_groups, stored, text_bytes
from actiflow.llm.components import connected_components
from actiflow.llm.simhash import shingle_hashes
from actiflow.sources.tables import read_table

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
ROWS = 3
MIN_WORDS = 20
SEED = 5
ROUNDS = 2
CHUNK = 1024


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """Least number of bands that collide once with probability ``recall`` at ``similarity``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))


def paragraphs(data: bytes, min_words: int):
    """(number, start, end, words, normalised) of each long enough line; code points."""
    at, ascii_only = 0, data.isascii()
    for number, line in enumerate(data.split(b"\n")):
        size = len(line) if ascii_only or line.isascii() else len(line.translate(None, CONTINUATION))
        words = line.lower().split()
        if len(words) >= min_words:
            yield number, at, at + size, len(words), b" ".join(words)
        at += size + 1


def blocks(data: bytes, min_words: int):
    """Like ``paragraphs``, but consecutive shorter lines are joined up to a blank or a long
    line, and a text without any long enough block is one block whatever its length.
    The number is that of the first line."""
    at, ascii_only, open_block, found = 0, data.isascii(), [], False

    def closed():
        words = [w for *_, line in open_block for w in line]
        if len(words) >= min_words:
            yield open_block[0][0], open_block[0][1], open_block[-1][2], len(words), b" ".join(words)
        open_block.clear()

    for number, line in enumerate(data.split(b"\n")):
        size = len(line) if ascii_only or line.isascii() else len(line.translate(None, CONTINUATION))
        words = line.lower().split()
        if not words or len(words) >= min_words:
            for block in closed():
                found = True
                yield block
        if len(words) >= min_words:
            found = True
            yield number, at, at + size, len(words), b" ".join(words)
        elif words:
            open_block.append((number, at, at + size, words))
        at += size + 1
    for block in closed():
        found = True
        yield block
    words = data.lower().split()
    if words and not found:
        yield 0, 0, at - 1, len(words), b" ".join(words)


def text_hash(normalised: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(normalised)
    return h - (1 << 64) if h >= 1 << 63 else h


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_id, data): the text as bytes and its hash."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("data")) \
        .select("doc_id", F.xxhash64("data").alias("text_id"), "data")


def occurrences(docs: DataFrame, min_words: int, id_col: str, text_col: str, cut: Callable = paragraphs) -> DataFrame:
    """(doc_id, text_id, row, paragraph, start, end, n_words, h): every long enough paragraph.
    ``row`` tells rows without doc_id apart; it holds as long as the result is stored."""
    work = keyed(docs, id_col, text_col).select(
        "doc_id", "text_id", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("row"), "data")

    def make():
        def each(batch: pa.RecordBatch) -> dict:
            rows = [(d, i, r, n, a, b, w, text_hash(t))
                    for d, i, r, x in zip(*(batch.column(c).to_pylist() for c in range(3)), batch.column(3))
                    for n, a, b, w, t in cut(x.as_py(), min_words)]
            return dict(zip(("doc_id", "text_id", "row", "paragraph", "start", "end", "n_words", "h"),
                            map(list, zip(*rows)) if rows else [[]] * 8))
        return each

    return map_arrow(work, make, "doc_id BIGINT, text_id BIGINT, row BIGINT, paragraph BIGINT, start BIGINT, "
                                 "`end` BIGINT, n_words BIGINT, h BIGINT")


def band_keys(grams: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per text and band, from the shingle hashes of all texts, one after the other."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    factors = rng.integers(0, 1 << 63, (bands, rows, 2), dtype=np.uint64) * 2 + 1
    keys = np.empty((len(starts), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(starts), b + 1, np.uint64)
        for a, c in factors[b]:
            mixed = grams * a
            mixed ^= mixed >> np.uint64(29)
            least = np.minimum.reduceat(mixed * c, starts)
            key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        keys[:, b] = key
    return keys


def banded(docs: DataFrame, min_words: int, bands: int, rows: int, text_col: str, cut: Callable = paragraphs) -> DataFrame:
    """(h, n, keys): distinct texts with their number of words and band keys."""
    def make():
        def each(batch: pa.RecordBatch) -> dict:
            out, seen = {"h": [], "n": [], "keys": []}, {}
            held, size = [], 0

            def flush():
                nonlocal held, size
                grams = [shingle_hashes(t, SHINGLE_WORDS) for _, _, t in held]
                starts = np.cumsum([0] + [len(g) for g in grams])
                keys = band_keys(np.concatenate(grams), starts[:-1], bands, rows).astype("<u8")
                out["h"] += [h for h, _, _ in held]
                out["n"] += [w for _, w, _ in held]
                out["keys"] += [k.tobytes() for k in keys]
                held, size = [], 0

            for x in batch.column(0):
                for _, _, _, w, t in cut(x.as_py(), min_words):
                    h = text_hash(t)
                    if h not in seen:
                        seen[h] = True
                        held.append((h, w, t))
                        size += w
                        if size > 1 << 18:
                            flush()
            if held:
                flush()
            return out
        return each

    return map_arrow(docs.select(text_bytes(text_col).alias("data")), make,
                     "h BIGINT, n BIGINT, keys BINARY").dropDuplicates(["h"])


def colliding(texts: DataFrame, bands: int) -> DataFrame:
    """(key, h, n): members of every bucket with two texts or more."""
    def make():
        def each(batch: pa.RecordBatch) -> dict:
            keys = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u8").view(np.int64)
            return {"key": keys, "h": np.repeat(batch.column(0).to_numpy(), bands),
                    "n": np.repeat(batch.column(1).to_numpy(), bands)}
        return each

    rows = map_arrow(texts, make, "key BIGINT, h BIGINT, n BIGINT")
    shared = rows.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a < b").select("key")
    return rows.join(shared, "key")


def shingle_sets(docs: DataFrame, firsts: DataFrame, min_words: int, id_col: str, text_col: str, cut: Callable = paragraphs) -> DataFrame:
    """(h, grams): sorted distinct shingle hashes of the texts whose one occurrence
    (doc_id, text_id, paragraph) is listed."""
    wanted = firsts.groupBy(F.col("doc_id").alias("of"), F.col("text_id").alias("of_text")).agg(
        F.collect_set("paragraph").alias("wanted"))  # at most one text's lines, also for null ids
    work = keyed(docs, id_col, text_col).join(
        wanted, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_id") == F.col("of_text"))).select("data", "wanted")

    def make():
        def each(batch: pa.RecordBatch) -> dict:
            out = {"h": [], "grams": []}
            for x, wanted in zip(batch.column(0), batch.column(1).to_pylist()):
                at = set(wanted)
                for n, _, _, _, text in cut(x.as_py(), min_words):
                    if n in at:
                        out["h"].append(text_hash(text))
                        out["grams"].append(np.unique(shingle_hashes(text, SHINGLE_WORDS)).view(np.int64))
            return out
        return each

    return map_arrow(work, make, "h BIGINT, grams ARRAY<BIGINT>").dropDuplicates(["h"])


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough."""
    left = sets.select(F.col("h").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("h").alias("b"), F.col("grams").alias("gb"))
    both = F.size(F.array_intersect("ga", "gb"))
    return (pairs.join(left, "a").join(right, "b")
            .filter(both >= similarity * (F.size("ga") + F.size("gb") - both) - 1e-9).select("a", "b"))


def star_pairs(members: DataFrame, number: int) -> DataFrame:
    """Every text with its bucket's pivot of this round, unless already connected.
    Sizes that differ too much cannot be similar, but the last stage checks them too."""
    pivot = F.min_by(F.struct("h", "root"), F.xxhash64("h", F.lit(number))).alias("p")
    pivots = members.groupBy("key").agg(pivot).select("key", F.col("p.h").alias("ph"), F.col("p.root").alias("pr"))
    return (members.join(pivots, "key").filter("root <> pr")
            .select(F.least("h", "ph").alias("a"), F.greatest("h", "ph").alias("b")).distinct())


def with_roots(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of buckets that still hold two components or more, with their root."""
    parts = connected_components(links)
    rooted = members.drop("root").join(parts, F.col("h") == F.col("node"), "left").select(
        "key", "h", "n", F.coalesce("root", "h").alias("root"))
    open_keys = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")) \
        .filter("x <> y").select("key")
    return rooted.join(open_keys, "key")


def reached(sets: list[np.ndarray], roots: np.ndarray, left: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links that connect the components of one cell: members on the left side are
    compared with every member that their component has not reached yet."""
    universe, flat = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    bounds = np.concatenate(([0], np.cumsum(np.bincount(flat, minlength=len(universe)))))
    owners, starts = owner[order], np.concatenate(([0], np.cumsum(sizes)))
    component, links = roots.copy(), []
    for i in np.nonzero(left)[0].tolist():
        shared = np.concatenate([owners[bounds[g]:bounds[g + 1]] for g in flat[starts[i]:starts[i + 1]].tolist()])
        both = np.bincount(shared, minlength=len(sets))
        near = both >= similarity * (sizes[i] + sizes - both) - 1e-9
        for j in np.nonzero(near & (component != component[i]))[0].tolist():
            if component[j] != component[i]:
                links.append((i, j))
                component[component == component[j]] = component[i]
    return links


def rest_links(members: DataFrame, sets: DataFrame, similarity: float, chunk: int) -> DataFrame:
    """Links among the texts of open buckets: those outside the bucket's largest component
    against all others, chunk by chunk. Two chunks of the largest component never meet."""
    parts = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    largest = parts.groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("big"),
                                       F.max("c").alias("nb"), F.sum("c").alias("nt"))
    sized = members.join(largest, "key").withColumn("in_big", F.col("root") == F.col("big"))
    chunks_big = F.ceil(F.col("nb") / chunk).cast("int")
    chunks_rest = F.ceil((F.col("nt") - F.col("nb")) / chunk).cast("int")
    # Cells are (chunk of the rest, chunk): chunks of the rest come first in numbering.
    mine = F.when(F.col("in_big"), chunks_rest + F.pmod(F.xxhash64("h"), chunks_big)).otherwise(
        F.pmod(F.xxhash64("h"), chunks_rest)).cast("int")
    other = F.when(F.col("in_big"), F.sequence(F.lit(0), chunks_rest - 1)).otherwise(
        F.sequence(F.lit(0), chunks_rest + chunks_big - 1))
    cells = (sized.withColumn("mine", mine).withColumn("other", F.explode(other))
             .select("key", F.least("mine", "other").alias("c1"), F.greatest("mine", "other").alias("c2"),
                     "mine", "h", "root"))

    def make():
        def each(table: pa.Table, bounds: np.ndarray) -> dict:
            h, root, mine, c1 = (table.column(c).to_numpy() for c in ("h", "root", "mine", "c1"))
            grams = table.column("grams").combine_chunks()
            values, ends = grams.values.to_numpy(), grams.offsets.to_numpy()
            a, b = [], []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if (root[lo:hi] == root[lo]).all():
                    continue
                sets = [values[ends[i]:ends[i + 1]] for i in range(lo, hi)]
                for i, j in reached(sets, root[lo:hi], mine[lo:hi] == c1[lo:hi], similarity):
                    a.append(h[lo + i])
                    b.append(h[lo + j])
            return {"a": a, "b": b}
        return each

    return map_groups(cells.join(sets, "h").select("key", "c1", "c2", "mine", "h", "root", "grams"),
                      ["key", "c1", "c2"], make, "a BIGINT, b BIGINT")


def classed(docs: DataFrame, id_col: str, text_col: str, min_words: int, similarity: float, recall: float,
            rows: int, rounds: int, chunk: int, cut: Callable) -> DataFrame:
    """The rows of ``repeated_paragraphs`` with text_id and row."""
    bands = tune_bands(similarity, recall, rows)
    found = stored(occurrences(docs, min_words, id_col, text_col, cut), "paragraphs")
    place = ["doc_id", "paragraph", "start", "text_id", "row"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("x"), *place))
    texts = stored(found.groupBy("h").agg(first.alias("first"), F.count(F.lit(1)).alias("times")), "texts")

    members = stored(colliding(stored(banded(docs, min_words, bands, rows, text_col, cut), "bands"), bands)
                     .withColumn("root", F.col("h")), "buckets")
    needed = texts.join(members.select("h").distinct(), "h").select("h", "first.doc_id", "first.text_id", "first.paragraph")
    sets = stored(shingle_sets(docs, needed, min_words, id_col, text_col, cut), "shingles")
    links = None
    for number in range(rounds):
        more = verified(star_pairs(members, number), sets, similarity)
        links = stored(more if links is None else links.union(more), "paragraph_links")
        members = stored(with_roots(members, links), "open_buckets")
    links = links.union(rest_links(members, sets, similarity, chunk))
    parts = connected_components(links)

    rooted = texts.join(parts, F.col("h") == F.col("node"), "left").select(
        "h", "first", "times", F.coalesce("root", "h").alias("root"))
    classes = rooted.groupBy("root").agg(F.min("first").alias("class"), F.sum("times").alias("size")) \
        .filter("size > 1")
    named = rooted.select("h", "root").join(classes, "root").select("h", "class")
    out = found.join(named, "h")
    is_first = reduce(and_, [F.col(c).eqNullSafe(F.col(f"class.{c}")) for c in place])
    return out.select("doc_id", "text_id", "row", "paragraph", "start", "end", "n_words",
                      F.col("class.doc_id").alias("class_doc_id"),
                      F.col("class.paragraph").alias("class_paragraph"), (~is_first).alias("removed"))


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_words: int = MIN_WORDS, similarity: float = SIMILARITY,
                        recall: float = RECALL, rows: int = ROWS, rounds: int = ROUNDS,
                        chunk: int = CHUNK, cut: Callable = paragraphs) -> DataFrame:
    """doc_id, paragraph, start, end, n_words, class_doc_id, class_paragraph, removed: one
    row per occurrence of a paragraph whose class has two or more; the class is named by
    its first occurrence, which alone is not removed."""
    return classed(docs, id_col, text_col, min_words, similarity, recall, rows, rounds, chunk, cut).drop("text_id", "row")


def repeated_blocks(docs: DataFrame, **options) -> DataFrame:
    """The same for blocks: short and wrapped copies take part."""
    return repeated_paragraphs(docs, cut=blocks, **options)


def repeated_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = MIN_WORDS, similarity: float = SIMILARITY, recall: float = RECALL,
                  rows: int = ROWS, rounds: int = ROUNDS, chunk: int = CHUNK) -> DataFrame:
    """``repeated_paragraphs`` of whole lines, then of what is repeated within and across other
    lines (``embedded``: start and end are those of the content-defined paragraph)."""
    lines = stored(classed(docs, id_col, text_col, min_words, similarity, recall, rows, rounds, chunk, paragraphs),
                   "repeated_lines")
    work = keyed(docs, id_col, text_col).select(
        "doc_id", "text_id", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("row"), "data")
    inside = embedded.repeated_units(work, lines.select("text_id", "start", "end"))
    return lines.drop("text_id", "row").withColumn("embedded", F.lit(False)).unionByName(
        inside.withColumn("embedded", F.lit(True)))


def op5_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_text(read_table(spark, sf_dir, "documents"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_words: int = MIN_WORDS, similarity: float = SIMILARITY, recall: float = RECALL,
                      rows: int = ROWS, rounds: int = ROUNDS, chunk: int = CHUNK) -> DataFrame:
    """doc_id, text_id, repeat, start, end: the merged spans to remove, of repeated blocks first and
    then of runs of ``runs.RUN`` words that what is left still repeats; see ``runs``."""
    found = stored(classed(docs, id_col, text_col, min_words, similarity, recall, rows, rounds, chunk, blocks)
                   .select("doc_id", "text_id", "row", "start", "end", "removed"), "repeated_blocks")
    whole = stored(runs.by_copy(found), "block_spans")
    more = runs.repeated_runs(keyed(docs, id_col, text_col), whole.filter("NOT repeat").drop("repeat"))
    return runs.merged(whole.union(runs.by_copy(more)))


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents"))
