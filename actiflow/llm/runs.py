"""Repeated runs of words, wherever they stand in a text.

1. Words are lower-cased and hashed; line ends do not matter. The anchors of a text are the
   least hashes of 20 words in each window of ``RUN`` words (winnowing), so two texts that
   share a window always share its anchor. Anchors that touch a span removed before do not count.
2. Texts with a shared anchor are read again. Every window of ``RUN`` words that has one, and
   touches no span removed before, goes out with its hash; equal hashes are one class.
3. Of a class the first occurrence (smallest doc_id, null last, then position) stays. The others are
   removed unless they overlap the first one in the same document.

So no run of ``RUN`` words is left twice, but where it overlaps itself, up to collisions of
64-bit hashes. Rows equal in doc_id and text share their spans; of equal texts without
doc_id one stays, and ``repeat`` marks the spans of all others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actiflow.llm.common import WHITE, map_arrow, stored

RUN = 51
GRAM = 20
WINDOW = RUN - GRAM + 1
KEY = ["doc_id", "text_id"]

_RNG = np.random.Generator(np.random.PCG64(11))
_BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xC2B2AE3D27D4EB4F]
_IS_WHITE = np.isin(np.arange(256), list(WHITE))


class Hasher:
    """Hashes of words and of runs of words by prefix sums modulo 2^64."""

    def __init__(self):
        self.powers = [(np.ones(1, np.uint64), np.ones(1, np.uint64))] * len(_BASES)

    def power(self, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers[k][0]) <= n:
            pair = []
            for base in (_BASES[k], pow(_BASES[k], -1, 1 << 64)):
                steps = np.full(2 * n + 1, base, np.uint64)
                steps[0] = 1
                pair.append(np.cumprod(steps, dtype=np.uint64))
            self.powers[k] = tuple(pair)
        return self.powers[k]

    def spans(self, k: int, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self.power(k, len(values))
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:len(values)], out=sums[1:])
        x = (sums[ends] - sums[starts]) * down[starts]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, end) of each word; code points."""
        raw = np.frombuffer(data.lower(), np.uint8)
        edge = np.diff(np.concatenate(([True], _IS_WHITE[raw], [True])).astype(np.int8))
        starts, ends = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
        hashes = self.spans(0, _BYTES[raw], starts, ends) if len(starts) else np.zeros(0, np.uint64)
        if not data.isascii():
            points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
            starts, ends = points[starts], points[ends]
        return hashes, starts, ends

    def runs(self, hashes: np.ndarray, size: int, k: int) -> np.ndarray:
        at = np.arange(len(hashes) - size + 1)
        return self.spans(k, hashes, at, at + size)

    def anchors(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first word) of the anchor of every window; the text has RUN words or more.
        Of equal hashes the leftmost is taken, so first words never go back."""
        least, width = self.runs(hashes, GRAM, 1), 1
        place = np.arange(len(least))
        while width < WINDOW:
            step = min(width, WINDOW - width)
            left = least[:-step] <= least[step:]
            place = np.where(left, place[:-step], place[step:])
            least = np.where(left, least[:-step], least[step:])
            width += step
        return least.view(np.int64), place


def text_anchors(work: DataFrame) -> DataFrame:
    """(doc_id, text_id, a, lo, hi): the anchors of a text with their first and last code points."""
    def make():
        hasher = Hasher()

        def each(batch: pa.RecordBatch) -> dict:
            rows, out = [], {"a": [], "lo": [], "hi": []}
            for i, x in enumerate(batch.column(2)):
                hashes, starts, ends = hasher.words(x.as_py())
                if len(hashes) < RUN:
                    continue
                least, place = hasher.anchors(hashes)
                new = np.concatenate(([True], place[1:] != place[:-1]))
                rows.append(i)
                out["a"].append(least[new])
                out["lo"].append(starts[place[new]])
                out["hi"].append(ends[place[new] + GRAM - 1])
            rows = pa.array(rows, pa.int64())
            return {"doc_id": batch.column(0).take(rows), "text_id": batch.column(1).take(rows)} | out
        return each

    return map_arrow(work, make, "doc_id BIGINT, text_id BIGINT, a ARRAY<BIGINT>, lo ARRAY<INT>, hi ARRAY<INT>")


def outside(anchors: DataFrame) -> DataFrame:
    """(doc_id, text_id, a): the anchors that touch no gone span. A window that touches none has
    such an anchor."""
    def make():
        def each(batch: pa.RecordBatch) -> dict:
            found = []
            for i, spans in enumerate(batch.column(5)):
                a, lo, hi = (batch.column(k)[i].values.to_numpy() for k in (2, 3, 4))
                if spans.is_valid and len(spans):
                    pairs = np.array(sorted((s["start"], s["end"]) for s in spans.as_py()))
                    before = np.searchsorted(pairs[:, 0], hi) - 1
                    a = a[(before < 0) | (np.maximum.accumulate(pairs[:, 1])[before] <= lo)]
                found.append(a)
            rows = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            return {"doc_id": batch.column(0).take(rows), "text_id": batch.column(1).take(rows),
                    "a": np.concatenate(found)}
        return each

    return map_arrow(anchors, make, "doc_id BIGINT, text_id BIGINT, a BIGINT")


def shared_windows(work: DataFrame) -> DataFrame:
    """(doc_id, text_id, row, at, start, end, w): windows with a shared anchor outside the gone spans."""
    def make():
        hasher = Hasher()

        def each(batch: pa.RecordBatch) -> dict:
            rows, out = [], {"at": [], "start": [], "end": [], "w": []}
            for i, x in enumerate(batch.column(3)):
                hashes, starts, ends = hasher.words(x.as_py())
                keep = np.isin(hasher.anchors(hashes)[0], batch.column(4)[i].values.to_numpy())
                spans = batch.column(5)[i].as_py() or []
                if spans:
                    change = np.zeros(len(hashes) + 1, np.int64)
                    np.add.at(change, np.searchsorted(starts, [s["start"] for s in spans]), 1)
                    np.add.at(change, np.searchsorted(starts, [s["end"] for s in spans]), -1)
                    gone = np.concatenate(([0], np.cumsum(np.cumsum(change)[:-1] > 0)))
                    keep &= gone[RUN:] == gone[:-RUN]
                at = np.nonzero(keep)[0]
                rows.append(np.full(len(at), i))
                out["at"].append(at)
                out["start"].append(starts[at])
                out["end"].append(ends[at + RUN - 1])
                out["w"].append(hasher.runs(hashes, RUN, 2)[at].view(np.int64))
            rows = pa.array(np.concatenate(rows))
            return {c: batch.column(k).take(rows) for k, c in enumerate(("doc_id", "text_id", "row"))} | {
                c: np.concatenate(v) for c, v in out.items()}
        return each

    return map_arrow(work, make, "doc_id BIGINT, text_id BIGINT, row BIGINT, at BIGINT, start BIGINT, `end` BIGINT, w BIGINT")


def by_copy(rows: DataFrame) -> DataFrame:
    """(doc_id, text_id, repeat, start, end) from (.., row, start, end, removed) of equal texts: the
    first copy loses what every copy loses, the others what any does."""
    same = rows.groupBy(*KEY, "start", "end").agg(
        F.min("removed").alias("all"), F.max("removed").alias("any"), (F.max("row") > F.min("row")).alias("copies"))
    first = same.filter("all").select(*KEY, F.lit(False).alias("repeat"), "start", "end")
    return first.union(same.filter("any AND copies").select(*KEY, F.lit(True).alias("repeat"), "start", "end"))


def repeated_runs(work: DataFrame, gone: DataFrame) -> DataFrame:
    """(doc_id, text_id, row, start, end, removed): one row per window that is repeated outside
    the spans ``gone`` (doc_id, text_id, start, end). ``work``: doc_id, text_id, data."""
    spans = gone.groupBy(*KEY).agg(F.collect_list(F.struct("start", "end")).alias("gone"))

    def same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(F.col("doc_id").alias("of"), F.col("text_id").alias("of_text"), *[
            c for c in right.columns if c not in KEY])
        on = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_id") == F.col("of_text"))
        return left.join(right, on, how).drop("of", "of_text")

    anchors = stored(outside(same(text_anchors(work), spans, "left").select(*KEY, "a", "lo", "hi", "gone")), "anchors")
    shared = stored(anchors.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a"), "shared_anchors")
    wanted = anchors.join(shared, "a").groupBy(*KEY).agg(F.collect_set("a").alias("wanted"))
    asked = stored(same(wanted, spans, "left"), "wanted_texts")
    row = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("row")
    texts = same(work, asked, "inner").select("doc_id", "text_id", row, "data", "wanted", "gone")
    windows = stored(shared_windows(texts), "windows")
    place = ["doc_id", "at", "text_id", "row"]
    classes = (windows.groupBy("w").agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), *place)).alias("c"),
                                        F.count(F.lit(1)).alias("n")).filter("n > 1").select("w", "c"))
    here = F.lit(True)
    for c in ("doc_id", "text_id", "row"):
        here = here & F.col(c).eqNullSafe(F.col(f"c.{c}"))
    return windows.join(classes, "w").select(
        *KEY, "row", "start", "end", (~(here & (F.col("at") - F.col("c.at") < RUN))).alias("removed"))


def merged(spans: DataFrame) -> DataFrame:
    """Overlapping spans, and spans with one character between them, as one."""
    grouped = spans.groupBy(*KEY, "repeat").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"))

    def make():
        def each(batch: pa.RecordBatch) -> dict:
            rows, a, b = [], [], []
            for i, spans in enumerate(batch.column(3)):
                pairs = spans.values
                start, end = pairs.field("start").to_numpy(), np.maximum.accumulate(pairs.field("end").to_numpy())
                new = np.concatenate(([True], start[1:] > end[:-1] + 1))
                a.append(start[new])
                b.append(end[np.append(np.nonzero(new)[0][1:] - 1, len(end) - 1)])
                rows.append(np.full(len(a[-1]), i))
            rows = pa.array(np.concatenate(rows))
            return {c: batch.column(k).take(rows) for k, c in enumerate(("doc_id", "text_id", "repeat"))} | {
                "start": np.concatenate(a), "end": np.concatenate(b)}
        return each

    return map_arrow(grouped, make, "doc_id BIGINT, text_id BIGINT, repeat BOOLEAN, start BIGINT, `end` BIGINT")
