"""Gapless numbers of a whole table in a given order, without one task over all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actiflow.llm.common import PREFIX, ensure_checkpoint

_WITHIN = (1 << 33) - 1  # monotonically_increasing_id: partition number << 33, then the row


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``: 0, 1, 2 ... over the whole table in ``order``.

    Ranges of the order are sorted in parallel and checkpointed (their bounds are sampled
    anew by each execution); a row's number is its place in its range plus the rows of the
    ranges before. Rows equal in every order column fall into one range, so the last order
    column should tell them apart.
    """
    spark = df.sparkSession
    ensure_checkpoint(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row, part, of, start = (PREFIX + x for x in ("row", "part", "of", "start"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint()
              .withColumn(row, F.monotonically_increasing_id())
              .withColumn(part, F.shiftright(row, 33)))
    # One row per range, so at most the number of shuffle partitions.
    before = Window.orderBy(of).rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy(F.col(part).alias(of)).agg(F.count(F.lit(1)).alias(PREFIX + "n"))
              .select(of, F.coalesce(F.sum(PREFIX + "n").over(before), F.lit(0)).alias(start)))
    return (ranged.join(F.broadcast(starts), F.col(part) == F.col(of))
            .withColumn(name, F.col(start) + F.col(row).bitwiseAND(F.lit(_WITHIN)))
            .drop(row, part, of, start))
