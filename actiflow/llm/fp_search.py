"""Ranked lexical search over document FP-trees.

One pass reads every whole text and keeps, per document, the number of its terms and the
frequencies of the terms that occur in the items (the restricted vector). Corpus counts come
from those stored vectors. Then blocks of documents become FP-trees: a document is the list
of its item terms by falling document frequency, documents that share a list's beginning
share the path, and unbranched paths are one node. A node holds, over its subtree, the
largest frequency of every term and the smallest m. Since a term's share of a score grows
with its frequency and falls with m, their weighted sum bounds every score below the node.
Each item walks the tree depth first, children in falling order of bound, and leaves a
subtree out once its bound is below the item's k-th score so far, which carries over from
block to block of a task. A subtree at an equal bound is entered, since ties go by doc_id.

Items are grouped so that a group's text is at most ``GROUP_BYTES`` (but for one longer
item), which bounds what is broadcast; equal item texts are searched once. Within a group,
trees are built for sets of items with at most ``TREE_TERMS`` terms (but for one item with
more). Each task returns its k best per item; the k best of parts, then of all, remain.

Defined cases: null text has no term; rows without an id are documents like others and rank
behind equal scores; rows with one id are documents of their own; items without text or
terms, or whose terms no document holds, have no rows; of rows with one item_id each is an
item; fewer than k scores above 0 give fewer rows; empty tables give an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from actiflow.llm.common import in_arrow, stored, text_bytes
from actiflow.sources.tables import read_table

# Fixed values of the contract: ranks, and terms = runs of ASCII letters, digits and all
# code points from U+0080.
TOP = 10
TERM = rb"[0-9A-Za-z\x80-\xff]+"
# Method parameters.
GROUP_BYTES = 4 << 20
TREE_TERMS = 4096
TREE_CELLS = 4 << 20   # documents x terms of one tree
LEAF = 16              # documents that are not split further
PARTS = 64             # parts of an item's rows before the last ranking

VECTOR = "doc BIGINT, n BIGINT, terms BINARY, tfs BINARY"
FOUND = "item BIGINT, part INT, doc BIGINT, score BIGINT"


def terms_of(text: bytes) -> list[bytes]:
    return re.findall(TERM, text.lower())  # bytes.lower changes A-Z only


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Documents with at least one term: number of terms, and ids and frequencies of those in
    the vocabulary (ascending)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = known.keys()
        for batch in batches:
            docs_, ns, terms, tfs = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms_of(text.as_py())
                if not found:
                    continue
                counts = Counter(found)
                own = sorted((known[t], counts[t]) for t in counts.keys() & names)
                docs_.append(doc)
                ns.append(len(found))
                terms.append(np.array([t for t, _ in own], "<i4").tobytes())
                tfs.append(np.array([c for _, c in own], "<i8").tobytes())
            if docs_:
                yield pa.RecordBatch.from_arrays([pa.array(docs_, pa.int64()), pa.array(ns, pa.int64()),
                                                  pa.array(terms), pa.array(tfs)], names=["doc", "n", "terms", "tfs"])

    return in_arrow(docs.select(F.col(id_col).cast("bigint").alias("doc"), text_bytes(text_col).alias("text")),
                    run, VECTOR)


def document_frequencies(table: DataFrame, size: int) -> np.ndarray:
    """Documents per term: counts of each task, summed by Spark; one row per term returns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            counts += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=size)
        at = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for term, n in in_arrow(table.select("terms"), run, "term INT, n BIGINT").groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return out


def shares(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's integer share of a score before its weight; 0 where it does not occur."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Tree:
    """FP-tree of a block: ``freq`` (documents x terms, most frequent term first) and m."""

    def __init__(self, freq: np.ndarray, m: np.ndarray, leaf: int = LEAF):
        here = freq > 0
        keys = [row.tobytes() for row in np.packbits(here, axis=1)]
        # Lists with a common beginning are neighbours in the order of presence bits.
        self.order = sorted(range(len(keys)), key=keys.__getitem__, reverse=True)
        self.freq, self.m = freq[self.order], m[self.order]
        rows, cols = np.nonzero(here[self.order])
        at = np.searchsorted(rows, np.arange(len(keys) + 1))
        self.lists = [cols[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
        self.bounds: list[tuple[int, int]] = []   # documents of a node
        self.children: list[list[int]] = []
        self.root = self._node(0, len(keys), leaf) if keys else None
        self.top = np.zeros((len(self.bounds), freq.shape[1]), freq.dtype)
        self.least = np.zeros(len(self.bounds), np.int64)
        for node in range(len(self.bounds) - 1, -1, -1):  # children come after their parent
            lo, hi = self.bounds[node]
            if self.children[node]:
                self.top[node] = self.top[self.children[node]].max(axis=0)
                self.least[node] = self.least[self.children[node]].min()
            else:
                self.top[node] = self.freq[lo:hi].max(axis=0)
                self.least[node] = self.m[lo:hi].min()

    def _node(self, lo: int, hi: int, leaf: int) -> int:
        """Nodes of the documents lo..hi-1, without recursion: paths can be long."""
        self.bounds.append((lo, hi))
        self.children.append([])
        open_nodes = [(0, 0)]
        while open_nodes:
            node, depth = open_nodes.pop()
            lo, hi = self.bounds[node]
            if hi - lo <= leaf:
                continue
            first, last = self.lists[lo], self.lists[hi - 1]
            while depth < len(first) and depth < len(last) and first[depth] == last[depth]:
                depth += 1
            cut = lo
            nexts = [x[depth] if len(x) > depth else -1 for x in self.lists[lo:hi]]
            if nexts[0] == nexts[-1]:
                continue  # equal lists
            for i in range(1, hi - lo + 1):
                if i == hi - lo or nexts[i] != nexts[i - 1]:
                    child = len(self.bounds)
                    self.bounds.append((cut, lo + i))
                    self.children.append([])
                    self.children[node].append(child)
                    open_nodes.append((child, depth))
                    cut = lo + i
        return 0

    def search(self, cols: np.ndarray, weights: np.ndarray, ids: list, best: list, k: int) -> int:
        """Updates ``best``, the ascending list of (-score, without id, id); returns the
        number of documents that were scored."""
        if self.root is None or not len(cols):
            return 0
        bounds = shares(self.top[:, cols].astype(np.int64), self.least[:, None]) @ weights
        scored = 0
        stack = [self.root]
        while stack:
            node = stack.pop()
            bound = int(bounds[node])
            if bound <= 0 or len(best) == k and bound < -best[-1][0]:
                continue
            below = self.children[node]
            if below:
                stack.extend(sorted(below, key=bounds.__getitem__))  # the largest bound is next
                continue
            lo, hi = self.bounds[node]
            scored += hi - lo
            scores = shares(self.freq[lo:hi, cols].astype(np.int64), self.m[lo:hi, None]) @ weights
            least = -best[-1][0] if len(best) == k else 1
            for i in np.nonzero(scores >= max(least, 1))[0].tolist():
                doc = ids[self.order[lo + i]]
                insort(best, (-int(scores[i]), doc is None, doc or 0))
                del best[k:]
        return scored


def item_sets(items: list[list[tuple[int, int]]], most: int = TREE_TERMS) -> list[list[int]]:
    """Runs of items whose terms number at most ``most`` together (one item at least)."""
    out: list[list[int]] = []
    held: set[int] = set()
    for i, item in enumerate(items):
        new = held | {t for t, _ in item}
        if out and len(new) <= most:
            out[-1].append(i)
            held = new
        else:
            out.append([i])
            held = {t for t, _ in item}
    return out


def searched(table: DataFrame, items: list[list[tuple[int, int]]], frequency: np.ndarray, documents: int,
             length: int, k: int) -> DataFrame:
    """(item, part, doc, score): the k best documents of every item in each task.
    ``items``: (term, occurrences) per item."""
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequency]
    sets = []
    for members in item_sets(items):
        terms = sorted({t for i in members for t, _ in items[i]}, key=lambda t: (-int(frequency[t]), t))
        place = {t: p for p, t in enumerate(terms)}
        sets.append((np.array(terms, np.int64), [
            (i, np.array([place[t] for t, _ in items[i]], np.int64),
             np.array([weight[t] * c for t, c in items[i]], np.int64)) for i in members]))
    shared = table.sparkSession.sparkContext.broadcast(sets)
    size = len(frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % PARTS
        sets = shared.value
        best: dict[int, list] = {}
        block = max(LEAF, TREE_CELLS // max([1, *(len(t) for t, _ in sets)]))

        def take(rows: pa.Table) -> None:
            ids = rows.column("doc").to_pylist()
            ns = rows.column("n").to_numpy()
            if int(ns.max()) * 75 * documents < 1 << 62:
                m = 25 + 75 * ns * documents // length
            else:
                m = np.array([25 + 75 * int(n) * documents // length for n in ns], np.int64)
            each = rows.column("terms").to_pylist()
            terms = np.frombuffer(b"".join(each), "<i4")
            tfs = np.frombuffer(b"".join(rows.column("tfs").to_pylist()), "<i8")
            row = np.repeat(np.arange(len(ids)), [len(x) // 4 for x in each])
            for wanted, members in sets:
                column = np.full(size, -1, np.int64)
                column[wanted] = np.arange(len(wanted))
                col = column[terms]
                of = col >= 0
                high = int(tfs[of].max(initial=0))
                freq = np.zeros((len(ids), len(wanted)), np.int32 if high < 1 << 31 else np.int64)
                freq[row[of], col[of]] = tfs[of]
                tree = Tree(freq, m)
                for item, cols, weights in members:
                    tree.search(cols, weights, ids, best.setdefault(item, []), k)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = block - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(min(room, batch.num_rows))
                if sum(b.num_rows for b in held) == block:
                    take(pa.Table.from_batches(held))
                    held = []
        if held:
            take(pa.Table.from_batches(held))
        found = [(i, part, None if none else doc, -score) for i, rows in best.items() for score, none, doc in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in found], t) for c, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
            names=["item", "part", "doc", "score"])

    return in_arrow(table, run, FOUND)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", k: int = TOP,
           group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    spark = docs.sparkSession
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    asked = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text).alias("asked"),
                         F.monotonically_increasing_id().alias("nr")).filter(F.col("asked").isNotNull())
    asked = stored(asked, "search_items")
    texts = asked.groupBy("asked").agg(F.min("nr").alias("nr"))
    total = texts.agg(F.sum(F.octet_length("asked"))).first()[0] or 0
    groups = -(-int(total) // group_bytes) or 1
    found = []
    for g in range(groups):
        # A group's distinct texts: about ``group_bytes`` in all.
        rows = texts.filter(F.pmod(F.xxhash64("asked"), F.lit(groups)) == g).orderBy("nr").collect()
        bags = [Counter(terms_of(r["asked"].encode())) for r in rows]
        vocabulary = {t: i for i, t in enumerate(sorted({t for b in bags for t in b}))}
        table = stored(vectors(docs, vocabulary, id_col, text_col), "search_vectors")
        size = table.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
        if not vocabulary or not size["documents"]:
            continue
        frequency = document_frequencies(table, len(vocabulary))
        bags = [sorted((vocabulary[t], c) for t, c in b.items() if frequency[vocabulary[t]]) for b in bags]
        top = searched(table, bags, frequency, size["documents"], size["length"], k)
        for keys in (["item", "part"], ["item"]):
            rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
            top = top.withColumn("rank", rank).filter(F.col("rank") <= k)
        numbers = spark.createDataFrame([(i, r["nr"]) for i, r in enumerate(rows)], "of BIGINT, nr BIGINT")
        found.append(top.join(numbers, F.col("item") == F.col("of")).select("nr", "rank", "doc", "score"))
    if not found:
        return spark.createDataFrame([], "item_id BIGINT, rank INT, doc_id BIGINT, score BIGINT")
    top = found[0]
    for more in found[1:]:
        top = top.unionByName(more)
    # Every item gets the rows of its text.
    same = texts.withColumnRenamed("asked", "text_of").withColumnRenamed("nr", "first")
    each = asked.join(same, F.col("asked") == F.col("text_of")).select("item_id", "first")
    return each.join(top, F.col("first") == F.col("nr")).select(
        "item_id", "rank", F.col("doc").alias("doc_id"), "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                  read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


OP13_SQL = r"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS nr,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents WHERE text IS NOT NULL
), d AS (SELECT doc_id, nr, words, len(words)::BIGINT AS n FROM t WHERE len(words) > 0),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS length FROM d),
q AS (
  SELECT item_id, nr AS item, term, count(*)::BIGINT AS times FROM (
    SELECT item_id, row_number() OVER () AS nr,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL
), f AS (
  SELECT nr, term, count(*)::BIGINT AS tf
  FROM (SELECT nr, unnest(words) AS term FROM d) SEMI JOIN (SELECT DISTINCT term FROM q) USING (term)
  GROUP BY nr, term
), w AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM f, c GROUP BY term
), scored AS (
  SELECT q.item_id, q.item, d.doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * d.n * c.n_docs) // c.length))))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term) JOIN d USING (nr), c
  GROUP BY q.item_id, q.item, d.nr, d.doc_id
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0)
WHERE rank <= 10
"""
