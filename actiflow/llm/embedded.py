"""Content-defined paragraphs: repeated passages inside longer lines and across short ones.

A whole line is no use as a unit where a passage stands inside it. So every text is also cut by
its content: a cut is a place whose hash of three words is the least within ``RADIUS`` places
on either side, and the paragraph around it is the ``UNIT`` words there. It depends on those
words only, so two texts that share a passage share the paragraphs inside it, wherever the
passage and its line ends are. A shared run of 51 words holds one with a probability of about
0.99; runs of one word or a short cycle have no cuts.

All texts of a batch are cut at once with numpy. A paragraph is known by a 128-bit hash of its
lower-cased words; equal hashes are one class, of which the first occurrence stays (smallest
doc_id, then place; null ids last).

Defined cases: as in ``paragraphs``; texts of fewer than ``UNIT`` words have no such paragraph.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actiflow.llm.common import WHITE, map_arrow, stored

RADIUS = 8
GRAM = 3
UNIT = 20
BEFORE = 9  # words of a paragraph before its cut
AT_ONCE = 1 << 19  # bytes of text hashed together

_RNG = np.random.Generator(np.random.PCG64(17))
# Two independent hashes: a number per byte value and an odd base each.
_BYTES = _RNG.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_IS_WHITE = np.isin(np.arange(256), list(WHITE))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


class Cutter:
    """Cuts texts; keeps the powers of its bases."""

    def __init__(self):
        self.powers = [(np.ones(1, np.uint64), np.ones(1, np.uint64))] * 2

    def _powers(self, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers[k][0]) < n:
            pair = []
            for base in (_BASES[k], pow(_BASES[k], -1, 1 << 64)):
                steps = np.full(n + n // 4, base, np.uint64)
                steps[0] = 1
                pair.append(np.cumprod(steps, dtype=np.uint64))
            self.powers[k] = tuple(pair)
        return self.powers[k]

    def _word_hashes(self, k: int, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self._powers(k, len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[k][raw] * up[:len(raw)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * down[starts])

    def cut(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """text (its number), paragraph (number of the line of the cut), start, end, mid (code
        points; of the paragraph and of the word at the cut), a, b (the hash)."""
        data = b"\n".join(texts).lower()
        raw = np.frombuffer(data, np.uint8)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        edge = np.diff(np.concatenate(([True], _IS_WHITE[raw], [True])).astype(np.int8))
        starts, ends = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
        none = {c: np.zeros(0, np.int64) for c in ("text", "paragraph", "start", "end", "mid", "a", "b")}
        if len(starts) < UNIT:
            return none
        words = [self._word_hashes(k, raw, starts, ends) for k in (0, 1)]
        text = np.searchsorted(begins, starts, side="right") - 1
        # The hash of GRAM words; places near a text's end have none.
        n = len(starts)
        grams = words[0].copy()
        for j in range(1, GRAM):
            grams[:n - j] = grams[:n - j] * np.uint64(_BASES[1]) + words[0][j:]
        grams = mixed(grams)
        whole = np.zeros(n, bool)
        whole[:n - GRAM + 1] = text[GRAM - 1:] == text[:n - GRAM + 1]
        far = np.uint64(0xFFFFFFFFFFFFFFFF)
        grams[~whole] = far
        least = whole.copy()
        for j in range(1, RADIUS + 1):
            # Of equal hashes the leftmost; neighbours in other texts do not count.
            same = text[j:] == text[:-j]
            least[j:] &= (grams[j:] < grams[:-j]) | ~same
            least[:-j] &= (grams[:-j] <= grams[j:]) | ~same
        at = np.nonzero(least)[0]
        at = at[(at >= BEFORE) & (at - BEFORE + UNIT <= n)]
        first, last = at - BEFORE, at - BEFORE + UNIT - 1
        inside = text[first] == text[last]
        at, first, last = at[inside], first[inside], last[inside]
        if not len(at):
            return none
        keys = []
        for k in (0, 1):
            window = words[k][first]
            for j in range(1, UNIT):
                window = window * np.uint64(_BASES[k]) + words[k][first + j]
            keys.append(mixed(window).view(np.int64))
        points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        lines = np.concatenate(([0], np.cumsum(raw == 10)))
        of = text[at]
        base = begins[of]
        return {"text": of, "paragraph": lines[starts[at]] - lines[base], "start": points[starts[first]] - points[base],
                "end": points[ends[last]] - points[base], "mid": points[starts[at]] - points[base],
                "a": keys[0], "b": keys[1]}


def batches_of(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first, texts): runs of texts of about ``AT_ONCE`` bytes."""
    held, size, first = [], 0, 0
    for i, x in enumerate(texts):
        held.append(x.as_py())
        size += len(held[-1])
        if size >= AT_ONCE:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def units(work: DataFrame) -> DataFrame:
    """Content-defined paragraphs of ``work`` (doc_id, text_id, row, data)."""
    def make():
        cutter = Cutter()

        def each(batch: pa.RecordBatch) -> dict:
            parts = []
            for first, texts in batches_of(batch.column(3)):
                found = cutter.cut(texts)
                found["text"] = found["text"] + first
                parts.append(found)
            out = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
            rows = pa.array(out.pop("text"))
            return {c: batch.column(k).take(rows) for k, c in enumerate(("doc_id", "text_id", "row"))} | out
        return each

    return map_arrow(work, make, "doc_id BIGINT, text_id BIGINT, row BIGINT, paragraph BIGINT, start BIGINT, "
                                 "`end` BIGINT, mid BIGINT, a BIGINT, b BIGINT")


def repeated_units(work: DataFrame, lines: DataFrame) -> DataFrame:
    """doc_id, paragraph, start, end, n_words, class_doc_id, class_paragraph, removed: one row per
    occurrence of a repeated content-defined paragraph whose cut is in none of ``lines``
    (text_id, start, end), the lines that are repeated as a whole."""
    found = stored(units(work), "units", "zstd")
    # Most paragraphs occur once; only the others are compared by place.
    shared = (found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
              .select("a", "b"))
    hits = stored(found.join(shared, ["a", "b"], "left_semi"), "repeated_units")
    place = ["doc_id", "start", "text_id", "row"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("x"), *place, "paragraph"))
    hits = hits.join(hits.groupBy("a", "b").agg(first.alias("class")), ["a", "b"])
    # Equal texts have equal lines: one row per text and line.
    gone = lines.select(F.col("text_id").alias("of"), F.col("start").alias("lo"), F.col("end").alias("hi")).distinct()
    covered = (F.col("text_id") == F.col("of")) & (F.col("mid") >= F.col("lo")) & (F.col("mid") < F.col("hi"))
    hits = hits.join(gone, covered, "left_anti")
    is_first = reduce(and_, [F.col(c).eqNullSafe(F.col(f"class.{c}")) for c in place])
    return hits.select("doc_id", "paragraph", "start", "end", F.lit(UNIT).cast("bigint").alias("n_words"),
                       F.col("class.doc_id").alias("class_doc_id"), F.col("class.paragraph").alias("class_paragraph"),
                       (~is_first).alias("removed"))
