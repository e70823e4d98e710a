"""Quality rules with host-level verdicts.

Every document gets rule counts from one pass over its whole text. A host (the
document's ``source``) gets the number of its documents that fail; its failure rate is
shrunk towards the corpus by an empirical beta prior, and hosts whose shrunk rate passes
``max_host_rate`` lose all their documents.

Defined cases: null text counts as empty (no words, so it fails); a null host is a
host of its own; a null doc_id is kept as null; repeated rows each count; an empty table
gives an empty result; extra columns are ignored (those named like a result are replaced).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actiflow.llm.common import CONTINUATION, PREFIX, WHITE, in_arrow, map_arrow, stored, text_bytes
from actiflow.sources.tables import read_table

# Fixed values of the base rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
# Host rule: share of failing documents above which a host is rejected whole.
MAX_HOST_RATE = 0.5

COUNTS = "n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, n_dup_lines BIGINT, n_repeat_words BIGINT"


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words covered by ``width``-word windows that occur twice or more."""
    if len(words) <= width:
        return 0
    windows = list(zip(*(words[i:] for i in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    seen, twice = set(), set()
    for w in windows:
        (twice if w in seen else seen).add(w)
    covered = end = 0
    for i, w in enumerate(windows):
        if w in twice:
            covered += i + width - max(i, end)
            end = i + width
    return covered


def rule_counts(data: bytes) -> tuple[int, int, int, int, int]:
    words = data.split()
    dense = data.translate(None, WHITE)
    chars = len(dense) if dense.isascii() else len(dense.translate(None, CONTINUATION))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = data.split(b"\n")
    dup = 0
    if len(lines) > 1 and len(set(lines)) < len(lines):
        filled = [x for x in lines if x.strip(WHITE)]
        dup = len(filled) - len(set(filled))
    return len(words), chars, symbols, dup, repeated_words(words)


def fails(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    host_col: str = "source") -> DataFrame:
    """doc_id, host, the rule counts and base_failed, one row per input row."""
    work = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(host_col).cast("string").alias("host"),
                       text_bytes(text_col).alias("data"))

    def make():
        def each(batch: pa.RecordBatch) -> dict:
            rows = [rule_counts(x) for x in batch.column(2).to_pylist()]
            n, chars, symbols, dup, repeat = zip(*rows)
            return {"doc_id": batch.column(0), "host": batch.column(1), "n_words": n,
                    "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup,
                    "n_repeat_words": repeat,
                    "base_failed": [fails(a, b) for a, b in zip(n, repeat)]}
        return each

    return map_arrow(work, make, f"doc_id BIGINT, host STRING, {COUNTS}, base_failed BOOLEAN")


def host_verdicts(counts: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, n_docs, n_failed, rate (shrunk), rejected: one row per host.

    The beta prior is fitted by moments over the hosts: its mean is the corpus failure
    rate, its strength follows from how much the host rates vary beyond binomial noise.
    The prior's two numbers are the only values that reach the driver.
    """
    hosts = counts.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.col("base_failed").cast("bigint")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    row = hosts.agg(F.sum("n_failed").alias("f"), F.sum("n_docs").alias("n"),
                    F.var_pop(rate).alias("v"),
                    F.avg(rate * (1 - rate) / F.col("n_docs")).alias("noise")).first()
    alpha, beta = beta_prior(row["f"] or 0, row["n"] or 0, row["v"] or 0.0, row["noise"] or 0.0)
    shrunk = (F.col("n_failed") + F.lit(alpha)) / (F.col("n_docs") + F.lit(alpha + beta))
    return hosts.withColumn("rate", shrunk).withColumn("rejected", F.col("rate") > max_rate)


def beta_prior(failed: int, total: int, variance: float, noise: float) -> tuple[float, float]:
    """(alpha, beta) by moments; strength is held within 1 and 10,000 documents."""
    mean = (failed + 1) / (total + 2)
    between = max(variance - noise, 1e-9)
    strength = min(max(mean * (1 - mean) / between - 1, 1.0), 1e4)
    return mean * strength, (1 - mean) * strength


def judge(docs: DataFrame, max_rate: float = MAX_HOST_RATE, id_col: str = "doc_id",
          text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Counts of every document with base_failed, host_rate and kept."""
    counts = stored(document_counts(docs, id_col, text_col, host_col), "quality_counts")
    hosts = host_verdicts(counts, max_rate).select(
        F.col("host").alias(PREFIX + "host"), F.col("rate").alias("host_rate"), "rejected")
    out = counts.join(hosts, F.col("host").eqNullSafe(F.col(PREFIX + "host")))
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("rejected")).drop(
        PREFIX + "host", "rejected")


def keep_good(docs: DataFrame, max_rate: float = MAX_HOST_RATE, text_col: str = "text",
              host_col: str = "source") -> DataFrame:
    """The documents that pass, with their own columns.

    Two passes over the texts instead of a shuffle of them: the first feeds the host
    table, the second drops failing texts where they lie; only rejected hosts are joined.
    """
    columns = docs.columns
    counts = stored(document_counts(docs.withColumn(PREFIX + "id", F.lit(None).cast("bigint")),
                                    PREFIX + "id", text_col, host_col)
                    .select("host", "base_failed"), "quality_hosts")
    bad = stored(host_verdicts(counts, max_rate).filter("rejected").select("host"),
                 "quality_rejected")
    flagged = docs.withColumn(PREFIX + "data", text_bytes(text_col))
    at = len(columns)

    def passing(batches):
        for batch in batches:
            ok = []
            for data in batch.column(at).to_pylist():
                words = data.split()
                ok.append(not fails(len(words), repeated_words(words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(at)], names=columns).filter(pa.array(ok, pa.bool_()))

    good = in_arrow(flagged, passing, docs.schema)
    bad = bad.select(F.col("host").alias(PREFIX + "host"))
    return good.join(bad, F.col(host_col).cast("string").eqNullSafe(F.col(PREFIX + "host")),
                     "left_anti").select(*columns)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM g)
  WHERE c > 1
), cover AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM r) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT x) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM w)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id
), c AS (
  SELECT w.doc_id, w.source, len(ws)::BIGINT AS n_words,
         length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
         coalesce(cover.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cover USING (doc_id) LEFT JOIN lines USING (doc_id)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c
), h AS (
  SELECT source, count(*) AS n, sum(base_failed::BIGINT) AS f FROM b GROUP BY source
), p AS (
  SELECT (sum(f) + 1) / (sum(n) + 2) AS m,
         greatest(var_pop(f / n) - avg((f / n) * (1 - f / n) / n), 1e-9) AS v FROM h
), s AS (
  SELECT m, least(greatest(m * (1 - m) / v - 1, 1.0), 1e4) AS k FROM p
), bad AS (
  SELECT source, (f + m * k) / (n + m * k + (1 - m) * k) > 0.5 AS rejected FROM h, s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM b JOIN bad ON b.source IS NOT DISTINCT FROM bad.source
"""
