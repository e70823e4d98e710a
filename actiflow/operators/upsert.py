"""Latest version per key: the read side of update-mode output.

Update mode emits a new row for a group whenever it changes; appended to a
table, old versions stay. The current value of each group is the version with
the highest epoch: ``max_by`` in a grouped aggregate (partial aggregation
before the shuffle, so a group updated in every epoch is not a hot task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(updates: DataFrame, keys: list[str], version_col: str = "epoch") -> DataFrame:
    values = [c for c in updates.columns if c not in keys and c != version_col]
    return (updates.groupBy(*keys)
            .agg(F.max_by(F.struct(*values), version_col).alias("_latest"))
            .select(*keys, *[F.col(f"_latest.{v}").alias(v) for v in values]))
