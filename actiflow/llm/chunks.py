"""Encoding of long texts chunk by chunk, with a bounded cache of chunks per worker.

A tokenizer whose pieces never cross certain spaces can encode the chunks between them
apart. Distinct chunks are encoded once; texts are then put together with numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class ChunkCache:
    """Ids of chunks. ``encode(chunks)`` fills the gaps: it returns the ids of all the
    chunks, one after the other, and how many each has."""

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]],
                 max_chunks: int = 200_000, max_ids: int = 4_000_000):
        self.encode, self.max_chunks, self.max_ids = encode, max_chunks, max_ids
        self.index: dict = {}
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.ends = np.zeros(1 << 14, dtype=np.int64)  # ends[k + 1]: end of chunk k

    def add(self, chunks: list[bytes]) -> None:
        ids, sizes = self.encode(chunks)
        k = len(self.index)
        start = int(self.ends[k])
        total = start + int(sizes.sum())
        if total > len(self.ids):
            self.ids = np.concatenate([self.ids[:start], np.empty(2 * total - start, np.uint32)])
        if k + len(sizes) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends[:k + 1], np.zeros(2 * (k + len(sizes)) + 2, np.int64)])
        self.ids[start:total] = ids
        self.ends[k + 1:k + 1 + len(sizes)] = start + np.cumsum(sizes)
        self.index.update(zip(chunks, range(k, k + len(chunks))))

    def spans(self, chunks: list) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each chunk lie in ``self.ids``, and how many there are; valid
        until the next call."""
        found = list(map(self.index.get, chunks))
        kept, new = len(self.index), []
        if None in found:
            gaps = [i for i, k in enumerate(found) if k is None]
            new = list(dict.fromkeys([chunks[i] for i in gaps]))
            self.add(new)
            for i in gaps:
                found[i] = self.index[chunks[i]]
        at = np.array(found, dtype=np.int64)
        starts = self.ends[at]
        sizes = self.ends[at + 1] - starts
        if len(self.index) > self.max_chunks or self.ends[len(self.index)] > self.max_ids:
            # Full: frequent chunks came early and stay, these were needed once.
            for c in new:
                del self.index[c]
        return starts, sizes

    def ids_of(self, chunks: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, one after the other, and how many each has."""
        if not chunks:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        starts, sizes = self.spans(chunks)
        return gather(self.ids, starts, sizes), sizes


def shared(holder: dict, name: str, build: Callable):
    """``build()`` once per worker process: kept with the broadcast value ``holder``, which
    a worker reads once and keeps for all its tasks."""
    if name not in holder:
        holder[name] = build()
    return holder[name]


def gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices pool[start:start + size], one after the other."""
    ends = np.cumsum(sizes)
    return pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


def encode_texts(texts: list[bytes], split: Callable[[bytes], Iterator[list[bytes]]],
                 cache: ChunkCache, at_once: int = 50_000) -> Iterator[np.ndarray]:
    """Id array of each text. ``split`` yields lists of chunks of bounded size."""
    chunks: list[bytes] = []
    parts: list[np.ndarray] = []  # of a text longer than one list
    counts: list[int] = []

    def flush():
        ids, sizes = cache.ids_of(chunks)
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum([0] + counts)]
        done = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
        chunks.clear()
        counts.clear()
        return done

    for text in texts:
        pieces = list_of = None
        for list_of in split(text):
            if pieces is not None:
                # A long text: encode what came before it, then it, list by list.
                parts.append(cache.ids_of(pieces)[0])
            pieces = list_of
        if parts:
            yield from flush()
            parts.append(cache.ids_of(pieces)[0])
            yield np.concatenate(parts)
            parts = []
            continue
        chunks.extend(pieces or [])
        counts.append(len(pieces or []))
        if len(chunks) >= at_once:
            yield from flush()
    yield from flush()


class WordCache:
    """Ids of words, each taken as a space and the word: ids in one numpy array, and a dict
    from the word to its place, kept from batch to batch. A million words take some 150 MB.
    ``encode(array of words)`` fills the gaps."""

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]],
                 max_words: int = 1_000_000, max_ids: int = 8_000_000):
        self.encode, self.max_words, self.max_ids = encode, max_words, max_ids
        self.place: dict = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = self.sizes = np.zeros(0, np.int64)

    def ids_of(self, words: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``words[at]`` one after the other, and how many each has; ``words`` are
        distinct."""
        # Bytes are made faster than text, and by NumPy faster than by to_pylist.
        listed = words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        known = self.place
        place = np.fromiter(map(known.get, listed, repeat(-1)), np.int64, len(listed))
        missing = place < 0
        ids, starts, sizes = self.ids, self.starts, self.sizes
        if missing.any():
            new = words.filter(pa.array(missing))
            more, counts = self.encode(new)
            place[missing] = len(starts) + np.arange(len(new))
            starts = np.concatenate([starts, len(ids) + np.cumsum(counts) - counts])
            sizes = np.concatenate([sizes, counts])
            ids = np.concatenate([ids, more])
            if len(starts) <= self.max_words and len(ids) <= self.max_ids:
                known.update(zip(compress(listed, missing.tolist()), place[missing].tolist()))
                self.ids, self.starts, self.sizes = ids, starts, sizes
            # else full: frequent words came early and stay, these were needed once
        at = place[at]
        return gather(ids, starts[at], sizes[at]), sizes[at]


def encode_plain(texts: pa.Array, words: WordCache, bare: ChunkCache | None) -> list[np.ndarray]:
    """Id array of each text, where every space has other characters on both sides.

    Words are split and numbered by Arrow; only distinct ones are looked up. With ``bare``
    the first word of a text has no space before it and is encoded there.
    """
    parts = pc.split_pattern(texts, " " if pa.types.is_string(texts.type) else b" ")
    bounds = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    coded = parts.flatten().dictionary_encode()
    at = coded.indices.to_numpy().astype(np.int64)
    if bare is None:
        ids, sizes = words.ids_of(coded.dictionary, at)
        ends = np.concatenate(([0], np.cumsum(sizes)))[bounds].tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]
    first = np.zeros(len(at), bool)
    first[bounds[:-1]] = True
    rest = at[~first]
    used = np.zeros(len(coded.dictionary), bool)
    used[rest] = True
    ids, sizes = words.ids_of(coded.dictionary.filter(pa.array(used)), (np.cumsum(used) - 1)[rest])
    ends = np.concatenate(([0], np.cumsum(sizes)))[bounds - np.arange(len(bounds))].tolist()
    heads, counts = bare.ids_of(coded.dictionary.take(pa.array(at[first])).to_pylist())
    cuts = np.concatenate(([0], np.cumsum(counts))).tolist()
    return [np.concatenate([heads[c:d], ids[a:b]]) for a, b, c, d in zip(ends, ends[1:], cuts, cuts[1:])]


def encode_column(texts: pa.Array, plain: np.ndarray, split: Callable, cache: ChunkCache, words: WordCache,
                  bare_first: bool, at_once: int = 1 << 22) -> Iterator[np.ndarray]:
    """Id array of each text: runs of plain texts together, others one by one."""
    sizes = pc.binary_length(texts).to_numpy()
    begin = 0
    while begin < len(texts):
        end = begin
        total = 0
        while end < len(texts) and plain[end] and (end == begin or total + sizes[end] <= at_once) \
                and sizes[end] <= at_once:
            total += sizes[end]
            end += 1
        if end > begin:
            yield from encode_plain(texts.slice(begin, end - begin), words, cache if bare_first else None)
        else:
            yield from encode_texts([texts[begin].as_py()], split, cache)
            end += 1
        begin = end


def by_bytes(sizes: np.ndarray, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """(start, length) of consecutive rows with at most ``most`` bytes, or of one row."""
    begin = 0
    while begin < len(sizes):
        total = np.cumsum(sizes[begin:])
        rows = max(1, int(np.searchsorted(total, most, side="right")))
        yield begin, rows
        begin += rows
