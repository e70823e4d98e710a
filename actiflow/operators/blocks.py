"""Ordered values (previous row, running sum, row number) without a hot task.

``Window.partitionBy(group)`` sends a whole group to one task and a window without
groups sends the table to one task. Here every group is cut into blocks of its order key
(a day, a range of ids). Window functions run within (group, block); one tail row per
block holds its last values, sums and count; a window over the tails carries them to the
next block, and a join brings them back. The plan has the same shape at every size and
holds Spark SQL expressions only.

Without groups the blocks are ranges of an integer key and the tails are blocked again,
until the top level cannot hold more than ``WIDTH`` rows whatever the key's values are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH = 1 << 16  # keys in a block of an ungrouped run: 64-bit keys need four levels
_BLOCK = "_block"


def _zero(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(0))


def previous_value(df: DataFrame, group: str, order_by: list[str], block: Column,
                   source: str, name: str, nulls: bool = True) -> DataFrame:
    """Adds ``name``: ``source`` of the previous row of the group (null for its first).

    ``block`` must rise with ``order_by``, which must be a total order in the group.
    ``nulls=False`` leaves rows whose group or block is null without values carried from
    other blocks; Spark can then drop the join where the new column is not used.
    """
    work = df.withColumn(_BLOCK, block)
    inside = Window.partitionBy(group, _BLOCK).orderBy(*order_by)
    tails = work.groupBy(group, _BLOCK).agg(
        F.max_by(F.struct(source), F.struct(*order_by)).alias("_last"))
    before = Window.partitionBy("_group").orderBy("_of")
    carried = (tails.select(F.col(group).alias("_group"), F.col(_BLOCK).alias("_of"), "_last")
               .withColumn("_carried", F.lag("_last").over(before)).drop("_last"))
    first = F.row_number().over(inside) == 1
    own = work.withColumn("_first", first).withColumn("_lag", F.lag(source).over(inside))
    if nulls:
        same = F.col(group).eqNullSafe(F.col("_group")) & F.col(_BLOCK).eqNullSafe(F.col("_of"))
    else:
        same = (F.col(group) == F.col("_group")) & (F.col(_BLOCK) == F.col("_of"))
    joined = own.join(carried, same, "left")
    value = F.when(F.col("_first"), F.col(f"_carried.{source}")).otherwise(F.col("_lag"))
    return joined.withColumn(name, value).drop(_BLOCK, "_group", "_of", "_carried", "_first", "_lag")


def _sums_before(tails: DataFrame, names: list[str], levels: int) -> DataFrame:
    """(_of, _before_<name>): sums over all blocks before each one."""
    if levels == 0:
        before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
        return tails.select("_of", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}")
                                     for n in names])
    work = tails.withColumn("_up", F.floor(F.col("_of") / WIDTH))
    before = Window.partitionBy("_up").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    own = work.select("_up", "_of", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_own_{n}")
                                      for n in names])
    upper = work.groupBy("_up").agg(*[F.sum(n).alias(n) for n in names]).withColumnRenamed("_up", "_of")
    carried = _sums_before(upper, names, levels - 1).withColumnRenamed("_of", "_above")
    return own.join(carried, F.col("_up").eqNullSafe(F.col("_above"))).select(
        "_of", *[(F.col(f"_own_{n}") + F.col(f"_before_{n}")).alias(f"_before_{n}") for n in names])


def running(df: DataFrame, key: str, running_sum: dict[str, str] | None = None,
            row_number: str | None = None) -> DataFrame:
    """Adds running sums (inclusive; nulls add 0) and the 1-based row number by the unique
    integer column ``key`` over the whole table."""
    sums = dict(running_sum or {})
    work = df.withColumn(_BLOCK, F.floor(F.col(key) / WIDTH))
    inside = Window.partitionBy(_BLOCK).orderBy(key).rowsBetween(Window.unboundedPreceding,
                                                                 Window.currentRow)
    aggregates = {name: F.sum(_zero(src)) for name, src in sums.items()}
    if row_number:
        aggregates[row_number] = F.count(F.lit(1))
    tails = work.groupBy(F.col(_BLOCK).alias("_of")).agg(*[a.alias(n) for n, a in aggregates.items()])
    carried = _sums_before(tails, list(aggregates), 3)
    out = work
    for name, aggregate in aggregates.items():
        out = out.withColumn(f"_in_{name}", aggregate.over(inside))
    out = out.join(carried, F.col(_BLOCK).eqNullSafe(F.col("_of")))
    for name in aggregates:
        kind = "long"
        if name in sums and not isinstance(df.schema[sums[name]].dataType, T.IntegralType):
            kind = "double"
        out = out.withColumn(name, (F.col(f"_in_{name}") + F.col(f"_before_{name}")).cast(kind))
    return out.drop(_BLOCK, "_of", *[f"_in_{n}" for n in aggregates], *[f"_before_{n}" for n in aggregates])
