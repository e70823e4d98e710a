"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiflow.session import checkpoint_dir, work_root
from actiflow.sinks.files import delete

# A word is a run of characters other than ASCII white space.
WORD_REGEX = r"[^\x20\x09-\x0D]+"
WHITE = b" \t\n\x0b\x0c\r"
# UTF-8 continuation bytes: code points of a byte string = its length without these.
CONTINUATION = bytes(range(0x80, 0xC0))

# Working columns carry this prefix, so extra input columns cannot clash with them.
PREFIX = "_llm_"


def text_bytes(col: str = "text") -> Column:
    """The text as UTF-8 bytes, null read as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def code_points(data: bytes) -> int:
    return len(data) - (0 if data.isascii() else len(data) - len(data.translate(None, CONTINUATION)))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose names (in any case) the operator is about to add."""
    taken = {n.lower() for n in names}
    return df.select(*[df[c] for c in df.columns if c.lower() not in taken])


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that operators store within the block are deleted at its end, so results that
    read them must be written before."""
    paths: list[str] = []
    token = _SCRATCH.set(paths)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in paths:
            delete(spark, path)


def stored(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """Write to a fresh table in the shared checkpoint folder and read it back:
    computed once, lineage cut, readable by every executor, with real size statistics."""
    spark = df.sparkSession
    path = work_root(spark, purpose)
    if (open_scope := _SCRATCH.get()) is not None:
        open_scope.append(path)
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoint(spark: SparkSession) -> str:
    return checkpoint_dir(spark)


# Rows go to Python workers in batches of at most so many bytes: texts can be long.
BATCH_BYTES = 4 << 20


def in_arrow(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes, not only by rows. The bound is a
    session setting that changes no result; it is lowered, never raised."""
    key, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    now = re.fullmatch(r"(\d+)b?", conf.get(key))
    if not now or not 0 < int(now[1]) <= BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[dict] | pa.RecordBatch]],
              schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with a worker-side function per batch.

    ``make()`` runs once per task and returns ``batch -> columns`` (a dict of lists
    or arrays); the helper shapes them to ``schema``. Empty batches are skipped.
    """
    struct = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    names = struct.fieldNames()
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cols = each(batch)
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=arrow.field(n).type)
                      for n, c in ((n, cols[n]) for n in names)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return in_arrow(df, run, struct)


def map_groups(df: DataFrame, keys: list[str], make: Callable, schema: T.StructType | str) -> DataFrame:
    """Run ``make()(table, bounds) -> columns`` over whole groups of rows with equal keys.

    One shuffle by the keys, one sort; rows then stream through the task, many small
    groups to a call: ``bounds`` holds the first row of each group and the end. Only the
    group that is still open is held back, so groups must be of bounded size.
    """
    struct = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    names = struct.fieldNames()
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(struct)

    def starts_of(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        new[0] = True
        for k in keys:
            col = table.column(k).to_numpy()
            new[1:] |= col[1:] != col[:-1]
        return np.nonzero(new)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()

        def out(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
            cols = each(table, np.append(starts, table.num_rows))
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=arrow.field(n).type)
                      for n, c in ((n, cols[n]) for n in names)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            # Nothing closes while the batch's last row continues the held group.
            if len(held) > 1 and all(held[0].column(k)[0] == batch.column(k)[batch.num_rows - 1]
                                     for k in (batch.schema.get_field_index(x) for x in keys)):
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            starts = starts_of(table)
            last = int(starts[-1])
            if last:
                yield out(table.slice(0, last), starts[:-1])
            held = table.slice(last).to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield out(table, starts_of(table))

    return in_arrow(df.repartition(*keys).sortWithinPartitions(*keys), run, struct)
