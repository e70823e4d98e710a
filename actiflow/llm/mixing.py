"""Mixing sources to target weights, in DataFrame operations only.

Words are summed per source; targets share all words by weight, no target above
``max_repeat`` times its source; each document is emitted floor(rate) times plus one
hash-seeded Bernoulli copy with probability equal to the fraction of its source's rate.

Defined cases: null text has size 0; the null source is a source of its own and comes
last; documents of size 0 are emitted like others; repeated rows with one doc_id draw the
same copy count; rows without doc_id draw by their text; an empty table gives an empty
result; extra columns stay (those named like a result are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from actiflow.llm.common import PREFIX, WORD_REGEX, ensure_checkpoint, stored, without
from actiflow.sources.tables import read_table

# Weights of the sources in code-point order, and the repetition limit.
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
SEED = "mix"


def word_count(col: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(col), F.lit("")), F.lit(WORD_REGEX)).cast("bigint")


def uniform(id_col: Column, text_col: Column, seed: str = SEED) -> Column:
    """Number in [0, 1) from the md5 of seed and id, or text where there is no id (48 bits,
    exact in a double)."""
    own = F.concat(F.lit("text:"), F.md5(F.coalesce(text_col, F.lit("")).cast("binary")))
    text = F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), own))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)


def source_order(sources: DataFrame) -> DataFrame:
    """Position (from 0) of each source by code point, null last, without one task over all:
    ranges of sources are numbered in parallel and shifted by the counts of earlier ranges."""
    ensure_checkpoint(sources.sparkSession)
    key = [F.col("source").asc_nulls_last()]
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Checkpointed, because range boundaries are sampled anew by each execution.
    ranged = sources.repartitionByRange(n, *key).checkpoint().withColumn(
        PREFIX + "part", F.spark_partition_id())
    local = ranged.withColumn(
        PREFIX + "at", F.row_number().over(Window.partitionBy(PREFIX + "part").orderBy(*key)) - 1)
    # One row per range: at most the number of shuffle partitions.
    before = Window.orderBy(PREFIX + "p").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy(F.col(PREFIX + "part").alias(PREFIX + "p"))
              .agg(F.count(F.lit(1)).alias(PREFIX + "n"))
              .select(PREFIX + "p", F.coalesce(F.sum(PREFIX + "n").over(before), F.lit(0))
                      .alias(PREFIX + "start")))
    return (local.join(starts, F.col(PREFIX + "part") == F.col(PREFIX + "p"))
            .withColumn("position", (F.col(PREFIX + "start") + F.col(PREFIX + "at")).cast("bigint"))
            .drop(PREFIX + "part", PREFIX + "at", PREFIX + "p", PREFIX + "start"))


def source_targets(sized: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size, weight, target, rate: one stored row per source.

    ``sized`` holds source and size. Targets above the limit stop there and the rest is
    shared again by weight until none is above; each round is one aggregate over the
    source table, of which three numbers reach the driver.
    """
    sums = sized.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]),
                          (F.col("position") % len(WEIGHTS) + 1).cast("int")).cast("bigint")
    table = stored(source_order(sums).withColumn("weight", weight)
                   .withColumn("cap", F.col("source_size") * max_repeat), "mix_sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    # A source stops when the share of one weight unit passes cap / weight; that share only grows.
    left, weights = total, table.agg(F.sum("weight")).first()[0] or 0
    stopped = F.lit(False)
    while weights:
        # Decimals: the cap of a large source times the weights of many passes 64 bits.
        stopped = F.col("weight") * F.lit(left).cast("decimal(19,0)") > \
            F.col("cap").cast("decimal(19,0)") * F.lit(weights).cast("decimal(18,0)")
        row = table.agg(F.sum(F.when(stopped, F.col("cap"))).alias("cap"),
                        F.sum(F.when(~stopped, F.col("weight"))).alias("weight")).first()
        now = (total - (row["cap"] or 0), row["weight"] or 0)
        if now == (left, weights):
            break
        left, weights = now
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(weights or 1))
    target = F.when(stopped, F.col("cap").cast("double")).otherwise(share)
    rate = F.when(F.col("source_size") > 0,
                  F.least(F.col("target") / F.col("source_size"), F.lit(float(max_repeat)))).otherwise(1.0)
    return stored(table.withColumn("target", target).withColumn("rate", rate)
                  .select("source", "source_size", "weight", "target", "rate"), "mix_targets")


def with_copies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                source_col: str = "source") -> DataFrame:
    """Documents with size, source_size, target, rate and copies (0 to ``MAX_REPEAT``).

    The documents are scanned twice and not shuffled when the source table is small by
    its measured size; otherwise Spark joins by source and splits the hot one.
    """
    added = ["size", "source_size", "target", "rate", "copies"]
    base = without(docs, *added).withColumn("size", word_count(text_col))
    targets = source_targets(base.select(F.col(source_col).cast("string").alias("source"), "size")).select(
        F.col("source").alias(PREFIX + "source"), "source_size", "target", "rate")
    joined = base.join(targets, F.col(source_col).cast("string").eqNullSafe(F.col(PREFIX + "source")))
    whole = F.floor("rate")
    extra = (uniform(F.col(id_col), F.col(text_col)) < F.col("rate") - whole).cast("int")
    return joined.withColumn("copies", (whole + extra).cast("int")).drop(PREFIX + "source")


def mix(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
        source_col: str = "source") -> DataFrame:
    """Every document as often as the mix takes it, with its own columns."""
    own = {PREFIX + "own_" + c: c for c in docs.columns}
    names = {c: n for n, c in own.items()}
    copied = with_copies(docs.select(*[docs[c].alias(n) for n, c in own.items()]),
                         names[text_col], names[id_col], names[source_col])
    return (copied.filter("copies > 0")
            .withColumn(PREFIX + "copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[F.col(n).alias(c) for n, c in own.items()]))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = with_copies(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).cast("bigint").alias("taken"))


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM d GROUP BY source
), t AS (SELECT sum(source_size)::BIGINT AS total, sum(weight)::BIGINT AS weights FROM s),
rounds(step, lft, weights) AS (
  SELECT 0, total, weights FROM t
  UNION ALL
  SELECT * FROM (
    SELECT r.step + 1,
           (any_value(t.total) - coalesce(sum(CASE WHEN s.weight * r.lft > 3 * s.source_size * r.weights
                                         THEN 3 * s.source_size END), 0))::BIGINT,
           coalesce(sum(CASE WHEN NOT s.weight * r.lft > 3 * s.source_size * r.weights
                             THEN s.weight END), 0)::BIGINT
    FROM rounds r, s, t WHERE r.step < 64 AND r.weights > 0 GROUP BY r.step)
), last AS (SELECT lft, weights FROM rounds ORDER BY step DESC LIMIT 1),
g AS (
  SELECT source, source_size,
         CASE WHEN weight * lft > 3 * source_size * weights THEN (3 * source_size)::DOUBLE
              ELSE (weight * lft)::DOUBLE / weights::DOUBLE END AS target
  FROM s, last
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 1.0 END AS rate FROM g
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + CASE WHEN
         (('0x' || left(md5('mix:' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))), 12))::BIGINT)::DOUBLE / 281474976710656.0
         < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""
