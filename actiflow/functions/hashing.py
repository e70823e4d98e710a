"""Partition-independent pseudo-random numbers.

``F.rand(seed)`` depends on how rows are split into partitions, so the same
input can give different values on another cluster size or after a retry.
A hash of (seed, row index, purpose) gives the same value wherever the row is
computed, and can be recomputed exactly in SQL:

    u = int(first 8 hex digits of md5('<seed>:<index>:<tag>'), 16) / 2^32   in [0, 1)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def uniform(seed: int, index, tag: str) -> Column:
    idx = F.col(index) if isinstance(index, str) else index
    text = F.concat_ws(":", F.lit(str(seed)), idx.cast("string"), F.lit(tag))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(TWO_POW_32)


def uniform_between(seed: int, index, tag: str, lo: float, hi: float) -> Column:
    """Like ``random.uniform(lo, hi)``."""
    return F.lit(lo) + uniform(seed, index, tag) * F.lit(hi - lo)


def randint(seed: int, index, tag: str, lo: int, hi: int) -> Column:
    """Like ``random.randint(lo, hi)``: inclusive at both ends."""
    return (F.lit(lo) + F.floor(uniform(seed, index, tag) * F.lit(hi - lo + 1))).cast("int")


def choice(seed: int, index, tag: str, options: list[str]) -> Column:
    k = F.floor(uniform(seed, index, tag) * F.lit(len(options))).cast("int") + F.lit(1)
    return F.element_at(F.array(*[F.lit(o) for o in options]), k)
