"""Quality classifier: similarity-weighted votes of labelled latent-semantic neighbours.

1. Every word of a text is two hashed features: itself, and its shape (letter case, digits
   and signs, runs collapsed); a word equal to the one before it is a feature too. Document
   frequencies are counted over all documents.
2. A bounded sample of labelled documents (at most ``MAX_LABELLED``, chosen by a hash of
   the id) gives the latent-semantic projection (truncated SVD of its tf-idf matrix) and
   the labelled vectors. Both are broadcast; their size is fixed by that bound.
3. Every document is projected and compared with every labelled vector, block by block;
   its ``NEIGHBOURS`` nearest vote with their labels, weighted by a power of their cosine.

Defined cases: null text counts as empty; a text without features, or without a neighbour
of positive cosine, gets the labelled share of label 1 (0.5 without labels); a null doc_id
is never held out; labels that are null or contradict each other for a document are not
used, repeated ones count once; repeated rows each give a row; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actiflow.llm.common import PREFIX, in_arrow, map_arrow, text_bytes
from actiflow.sources.tables import read_table

# Method parameters.
WORD_FEATURES, SHAPE_FEATURES = 3072, 1024
FEATURES = WORD_FEATURES + SHAPE_FEATURES
SHAPE_WEIGHT = 2.0  # of the shape part of a vector, against 1 for the words
RANK = 64
MAX_LABELLED = 4000
NEIGHBOURS = 15
POWER = 4
BLOCK = 256
ITERATIONS = 6
SEED = 11
# Fixed values of the contract.
HELD_OUT = 2
ACCEPT = 0.7

_SHAPE = bytes(0x61 if chr(i).islower() or i >= 0x80 else 0x41 if chr(i).isupper()
               else 0x30 if chr(i).isdigit() else i for i in range(256))
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


class Features:
    """Hashed feature counts of texts, with a bounded cache of words per task."""

    def __init__(self, max_words: int = 200_000):
        self.max_words, self.cache = max_words, {}

    def of_word(self, word: bytes) -> tuple[int, int]:
        try:
            upper = word.decode()
            upper = "".join("A" if c.isupper() else "a" if c.isalpha() else c for c in upper).encode() \
                if not word.isascii() else word
        except UnicodeDecodeError:
            upper = word
        shape = _RUNS.sub(rb"\1", upper.translate(_SHAPE))
        found = (zlib.crc32(word.lower()) % WORD_FEATURES,
                 WORD_FEATURES + 1 + zlib.crc32(shape) % (SHAPE_FEATURES - 1))
        if len(self.cache) >= self.max_words:
            self.cache.clear()
        self.cache[word] = found
        return found

    def counts(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(features, counts), without order; a feature may come more than once."""
        words = data.split()
        seen = Counter(words)
        get = self.cache.get
        pairs = [get(w) or self.of_word(w) for w in seen]
        at = np.array(pairs, np.int64).reshape(-1, 2)
        n = np.fromiter(seen.values(), np.float32, len(seen))
        again = sum(map(bytes.__eq__, words, words[1:]))
        # The first shape feature is the word that repeats the one before it.
        return (np.concatenate([at[:, 0], at[:, 1], [WORD_FEATURES]]),
                np.concatenate([n, n, [again]]).astype(np.float32))

    def matrix(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), FEATURES), np.float32)
        for i, data in enumerate(texts):
            at, n = self.counts(data)
            out[i] = np.bincount(at, n, FEATURES)
        return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """tf-idf rows; the word part has length 1, the shape part ``SHAPE_WEIGHT``."""
    rows = np.log1p(counts) * idf
    for part, weight in ((slice(0, WORD_FEATURES), 1.0), (slice(WORD_FEATURES, None), SHAPE_WEIGHT)):
        norm = np.linalg.norm(rows[:, part], axis=1, keepdims=True)
        rows[:, part] *= weight / np.where(norm > 0, norm, 1)
    return rows


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def projection(rows: np.ndarray, rank: int = RANK) -> np.ndarray:
    """The leading right singular vectors of ``rows`` by subspace iteration."""
    rank = min(rank, *rows.shape)
    basis = np.random.Generator(np.random.PCG64(SEED)).standard_normal(
        (rows.shape[1], min(rank + 8, *rows.shape))).astype(np.float32)
    for _ in range(ITERATIONS):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    _, _, v = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ v.T)[:, :rank].astype(np.float32)


def votes(vectors: np.ndarray, labelled: np.ndarray, labels: np.ndarray, prior: float,
          k: int = NEIGHBOURS) -> np.ndarray:
    """Score of each vector: labels of its nearest labelled vectors by cosine."""
    if not len(labelled):
        return np.full(len(vectors), prior)
    cosines = vectors @ labelled.T
    k = min(k, len(labelled))
    near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** POWER
    total = weight.sum(axis=1)
    share = (weight * labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
    return np.clip(np.where(total > 0, share, prior), 0, 1)


def inverse_frequencies(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """idf of every hashed feature over all documents; one number per feature."""
    def counted(batches):
        features, total, rows = Features(), np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for x in batch.column(0):
                at, n = features.counts(x.as_py())
                total[np.unique(at[n > 0])] += 1
                rows += 1
        at = np.append(np.nonzero(total)[0], FEATURES)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()),
                                          pa.array(np.append(total, rows)[at], pa.int64())], names=["f", "n"])

    rows = (in_arrow(docs.select(text_bytes(text_col).alias("data")), counted, "f BIGINT, n BIGINT")
            .groupBy("f").agg(F.sum("n").alias("n")).collect())
    found = {r["f"]: r["n"] for r in rows}
    total = found.get(FEATURES, 0)
    seen = np.array([found.get(i, 0) for i in range(FEATURES)], np.float64)
    return (np.log((1 + total) / (1 + seen)) + 0.1).astype(np.float32)


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id",
                    text_col: str = "text", limit: int = MAX_LABELLED) -> tuple[list[bytes], np.ndarray]:
    """Texts and labels of at most ``limit`` labelled documents that are not held out."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).cast("bigint").alias(PREFIX + "id"))
             .agg(F.min(label_col).alias(PREFIX + "label"), F.max(label_col).alias("most"))
             .filter(F.col(PREFIX + "label") == F.col("most")).drop("most"))
    drawn = known.orderBy(F.xxhash64(PREFIX + "id"), PREFIX + "id").limit(limit)
    # The sample has at most ``limit`` rows of two numbers.
    texts = (docs.join(F.broadcast(drawn), F.col(id_col).cast("bigint") == F.col(PREFIX + "id"))
             .select(F.col(PREFIX + "id").alias("id"), F.col(PREFIX + "label").cast("double").alias("label"),
                     text_bytes(text_col).alias("data")))
    rows = packed_counts(texts).groupBy("id").agg(F.first("label"), F.min("counts")).collect()
    rows.sort()
    return [bytes(r[2]) for r in rows], np.array([r[1] for r in rows])


def packed_counts(texts: DataFrame) -> DataFrame:
    """(id, label, counts): feature counts as bytes, features (4 bytes each), then counts."""
    def make():
        features = Features()

        def each(batch: pa.RecordBatch) -> dict:
            out = []
            for x in batch.column(2):
                at, n = features.counts(x.as_py())
                total = np.bincount(at, n, FEATURES)
                at = np.nonzero(total)[0]
                out.append(at.astype("<u4").tobytes() + total[at].astype("<f4").tobytes())
            return {"id": batch.column(0), "label": batch.column(1), "counts": out}
        return each

    return map_arrow(texts, make, "id BIGINT, label DOUBLE, counts BINARY")


def unpacked_counts(rows: list[bytes]) -> np.ndarray:
    out = np.zeros((len(rows), FEATURES), np.float32)
    for i, data in enumerate(rows):
        half = len(data) // 2
        out[i, np.frombuffer(data[:half], "<u4")] = np.frombuffer(data[half:], "<f4")
    return out


def score_documents(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score: the weighted vote for label 1, for every document."""
    spark = docs.sparkSession
    idf = inverse_frequencies(docs, text_col)
    packed, known = training_sample(docs, labels, label_col, id_col, text_col)
    prior = float(known.mean()) if len(known) else 0.5
    rows = weighted(unpacked_counts(packed), idf)
    axes = projection(rows) if len(rows) else np.zeros((FEATURES, 1), np.float32)
    model = spark.sparkContext.broadcast((idf, axes, unit(rows @ axes).astype(np.float32), known))
    work = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("data"))

    def make():
        idf, axes, labelled, known = model.value
        features = Features()

        def each(batch: pa.RecordBatch) -> dict:
            scores = []
            for at in range(0, batch.num_rows, BLOCK):
                texts = batch.column(1).slice(at, BLOCK).to_pylist()
                vectors = unit(weighted(features.matrix(texts), idf) @ axes)
                scores.append(votes(vectors, labelled, known, prior))
            return {"doc_id": batch.column(0), "score": np.concatenate(scores)}
        return each

    return map_arrow(work, make, "doc_id BIGINT, score DOUBLE")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
