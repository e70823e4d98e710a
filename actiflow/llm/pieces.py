"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

The model file's pieces become a double-array trie with log scores, built once on the
driver and broadcast (its size is that of the vocabulary). A text gets the marker of a
leading space; spaces become word markers. No piece of such a vocabulary holds a marker
after another character, so the best path of a text is the best paths of its words, put
together: distinct words are matched and scored many at a time with numpy, long stretches
without spaces one by one. A character that no piece covers is written as its UTF-8 bytes.
Decoding turns markers into spaces and byte pieces into bytes and drops the leading space.

Scores: a Unigram model's own log scores; the merge ranks of a BPE model are read as the
ranks of Zipf's law, log p = -log(rank + 1) - log(sum of 1 / (rank + 1)), rounded to
1/1024 so that sums are exact.

Defined cases: null text stays null with no ids; the empty text has no ids; any bytes
survive the round trip (a literal U+2581 is written as bytes); of paths with equal scores
the one whose last piece is longest wins, word by word; repeated rows give equal rows; an
empty table gives an empty result; extra columns stay (those named like a result are
replaced).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actiflow.llm.chunks import (ChunkCache, WordCache, by_bytes, encode_column, gather,
                                 shared)
from actiflow.llm.common import in_arrow, map_arrow, text_bytes, without
from actiflow.sources.tables import read_table

# Fixed values of the model format.
MARKER = "▁"
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
UNIGRAM = 1
UNKNOWN_PENALTY = 10.0
# Method parameters.
LONG_WORD = 64  # bytes; longer words are scored one by one
SLICE = 1 << 20


@dataclass
class PieceModel:
    """Pieces as a double-array trie over bytes (a space is the word marker)."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # piece id at a node, -1 if no piece ends there
    score: np.ndarray  # log score by piece id
    byte_id: np.ndarray  # piece id of each byte
    unknown: float
    longest: int
    pool: np.ndarray  # decoded bytes of all pieces, one after the other
    ends: np.ndarray
    plain_words: bool  # no piece has a space after another character


def double_array(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of the sorted keys. Child of node s by byte c: base[s] + c + 1.

    Nodes are placed breadth first, each at the first base whose places are all free; the
    search of nodes with several children moves on past places that keep failing, which
    nodes with one child fill later.
    """
    taken = bytearray(1 << 12)
    placed: dict[int, int] = {0: 0}  # place -> parent
    base: dict[int, int] = {}
    value: dict[int, int] = {}
    taken[0] = 1
    free, free_many = 1, 1
    queue = [(0, 0, len(keys), 0)]  # node, first and last key, depth
    for node, lo, hi, depth in queue:
        if lo < hi and len(keys[lo][0]) == depth:
            value[node] = keys[lo][1]
            lo += 1
        if lo == hi:
            continue
        spans, start = [], lo
        for k in range(lo + 1, hi + 1):
            if k == hi or keys[k][0][depth] != keys[start][0][depth]:
                spans.append((keys[start][0][depth] + 1, start, k))
                start = k
        first = spans[0][0]
        rest = [c - first for c, _, _ in spans[1:]]
        at = taken.find(0, max(free if not rest else free_many, first))
        tries = 0
        while True:
            if at < 0 or at + 258 > len(taken):
                taken.extend(bytes(len(taken)))
                at = at if at >= 0 else taken.find(0, free)
                continue
            if not any(taken[at + c] for c in rest):
                break
            tries += 1
            at = taken.find(0, at + 1)
        if rest and tries > 100:
            free_many = at - 100
        elif not rest and first <= free:
            free = at
        base[node] = at - first
        for c, s, e in spans:
            place = at - first + c
            taken[place] = 1
            placed[place] = node
            queue.append((place, s, e, depth + 1))
    size = max(placed) + 258
    arrays = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    for array, entries in zip(arrays, (base, placed, value)):
        array[list(entries)] = list(entries.values())
    return arrays


def load_model(path: str) -> PieceModel:
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    return piece_model([(p.piece, p.score, p.type) for p in proto.pieces],
                       proto.trainer_spec.model_type == UNIGRAM)


def piece_model(pieces: list[tuple[str, float, int]], unigram: bool) -> PieceModel:
    score = log_scores(pieces, unigram)
    byte_id, keys, decoded = np.full(256, -1, np.int64), [], []
    for i, (piece, _, kind) in enumerate(pieces):
        data = b""
        if kind == BYTE:
            data = bytes([int(piece[1:-1], 16)])
            byte_id[data[0]] = i
        elif kind in (NORMAL, USER_DEFINED):
            data = piece.replace(MARKER, " ").encode()
            keys.append((data, i))
        decoded.append(data)
    keys.sort()
    base, check, value = double_array(keys)
    scored = [score[i] for _, i in keys]
    return PieceModel(base, check, value, score, byte_id, min(scored) - UNKNOWN_PENALTY,
                      max(len(k) for k, _ in keys), np.frombuffer(b"".join(decoded), np.uint8),
                      np.cumsum([0] + [len(d) for d in decoded]),
                      not any(re.search(rb"[^ ] ", k) for k, _ in keys))


def log_scores(pieces: list[tuple[str, float, int]], unigram: bool) -> np.ndarray:
    raw = np.array([s for _, s, _ in pieces], np.float64)
    if unigram:
        return raw
    rank = -raw
    mine = np.array([kind in (NORMAL, USER_DEFINED) for _, _, kind in pieces])
    total = (1 / (rank[mine] + 1)).sum()
    return np.round((-np.log(np.maximum(rank, 0) + 1) - np.log(total)) * 1024) / 1024


def matches(model: PieceModel, text: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """By length (from 1): (start positions, piece ids) of all pieces in the words that
    lie one after the other in ``text``; ``ends[p]`` is the end of the word at p."""
    found = []
    at = np.nonzero((text & 0xC0) != 0x80)[0]  # pieces start at characters
    node = np.zeros(len(at), np.int64)
    for length in range(1, model.longest + 1):
        inside = at + length <= ends[at]
        at, node = at[inside], node[inside]
        step = model.base[node] + text[at + length - 1].astype(np.int64) + 1
        ok = model.check[step] == node
        at, node = at[ok], step[ok]
        if not len(at):
            break
        piece = model.value[node]
        ends_here = piece >= 0
        found.append((at[ends_here], piece[ends_here]))
    return found


def char_sizes(text: np.ndarray) -> np.ndarray:
    """Bytes of the character that starts at each position (1 within a character)."""
    return np.select([text >= 0xF0, text >= 0xE0, text >= 0xC0], [4, 3, 2], 1)


def viterbi(model: PieceModel, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all words by the best sum of log scores, and how many each has."""
    if not words:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    text = np.frombuffer(b"".join(words), np.uint8)
    last = np.cumsum(sizes)
    first = last - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    found = matches(model, text, last[word])
    # Characters without a piece of their own get the unknown score.
    width = np.minimum(char_sizes(text), last[word] - np.arange(len(text)))
    unknown = (text & 0xC0) != 0x80
    for length, (at, _) in enumerate(found[:4], 1):
        unknown[at[width[at] == length]] = False
    lone = (text & 0xC0) == 0x80  # a stray continuation byte at a word's start, or after one
    if lone.any():
        covered = np.zeros(len(text) + 1, np.int64)
        heads = np.nonzero(~lone)[0]
        np.add.at(covered, heads, 1)
        np.add.at(covered, heads + width[heads], -1)
        stray = lone & (np.cumsum(covered)[:-1] == 0)
        unknown |= stray
    best = np.full(len(text) + len(words), -np.inf)  # one place before each byte, one at the end
    place = np.arange(len(text)) + word
    best[first + np.arange(len(words))] = 0.0
    back_size = np.zeros(len(best), np.int32)
    back_id = np.zeros(len(best), np.int32)

    # All candidate pieces, by the end they reach, longest first.
    at = np.concatenate([a for a, _ in found] + [np.nonzero(unknown)[0]])
    ids = np.concatenate([i for _, i in found] + [np.full(int(unknown.sum()), -1, np.int32)])
    size = np.concatenate([np.full(len(a), n) for n, (a, _) in enumerate(found, 1)]
                          + [width[unknown]])
    gain = np.where(ids >= 0, model.score[ids], model.unknown)
    begin = place[at]
    end = begin + size
    depth = at + size - first[word[at]]  # bytes of the word that are covered
    long = sizes[word[at]] > LONG_WORD
    for chosen in (np.nonzero(~long)[0], np.nonzero(long)[0]):
        if not len(chosen):
            continue
        alone = long[chosen[0]]
        steps = (end[chosen] if alone else depth[chosen]) * (model.longest + 5) - size[chosen]
        by = np.argsort(steps, kind="stable")
        order, steps = chosen[by], steps[by]
        if alone:
            for b, e, g, s, i in zip(begin[order].tolist(), end[order].tolist(), gain[order].tolist(),
                                     size[order].tolist(), ids[order].tolist()):
                if best[b] + g > best[e]:
                    best[e], back_size[e], back_id[e] = best[b] + g, s, i
            continue
        # Words side by side: all ends at one depth, one piece length at a time.
        cuts = np.concatenate(([0], np.nonzero(np.diff(steps))[0] + 1, [len(order)]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            k = order[a:b]
            value, e = best[begin[k]] + gain[k], end[k]
            better = value > best[e]
            k, e = k[better], e[better]
            best[e], back_size[e], back_id[e] = value[better], size[k], ids[k]

    # Walk all words back at once.
    here = last + np.arange(len(words))
    start = first + np.arange(len(words))
    active = np.nonzero(here > start)[0]
    owner, piece, where = [], [], []
    while len(active):
        e = here[active]
        owner.append(active)
        piece.append(back_id[e])
        where.append(e - back_size[e])
        here[active] = where[-1]
        active = active[here[active] > start[active]]
    owner, piece, where = (np.concatenate(x) for x in (owner, piece, where))
    order = np.argsort(where, kind="stable")
    owner, piece, where = owner[order], piece[order].astype(np.int64), where[order]
    # Unknown characters become their bytes.
    lost = piece < 0
    if lost.any():
        p = where[lost] - owner[lost]
        n = width[p]
        many = np.ones(len(piece), np.int64)
        many[lost] = n
        data = model.byte_id[text[gather(np.arange(len(text)), p, n)]]
        piece, owner, lost = np.repeat(piece, many), np.repeat(owner, many), np.repeat(lost, many)
        piece[lost] = data
    return piece.astype(np.uint32), np.bincount(owner, minlength=len(words))


def split_words(data: bytes) -> Iterator[list[bytes]]:
    """Lists of words with the spaces before them; the text gets one leading space."""
    at, data = 0, b" " + data if data else data
    while at < len(data):
        stop = len(data)
        if stop - at > SLICE:
            cut = re.compile(rb"[^ ] ").search(data, at + SLICE)
            stop = cut.start() + 1 if cut else stop
        part = data[at:stop]
        if b"  " in part or part[-1:] == b" ":
            yield re.findall(rb" *[^ ]+| +", part)
        else:
            yield [b" " + w for w in part[1:].split(b" ")] if part[:1] == b" " else \
                re.findall(rb" *[^ ]+", part)
        at = stop


def decode_ids(model: PieceModel, ids: np.ndarray) -> bytes:
    """The text's bytes, without the space that encoding puts in front."""
    starts = model.ends[ids]
    data = gather(model.pool, starts, model.ends[ids + 1] - starts).tobytes()
    return data[1:] if data[:1] == b" " else data


def encoder(model: PieceModel):
    """Binary array of texts -> id arrays, with a bounded cache of words."""
    cache = ChunkCache(lambda words: viterbi(model, words))
    words = WordCache(lambda words: viterbi(model, [b" " + w for w in words.to_pylist()]),
                      max_words=250_000, max_ids=2_000_000)
    split = split_words if model.plain_words else (lambda data: iter([[b" " + data]] if data else []))

    def encode(texts: pa.Array):
        odd = pc.match_substring_regex(texts, "^ |  | $|^$").to_numpy(zero_copy_only=False)
        return encode_column(texts, ~odd & model.plain_words, split, cache, words, bare_first=False,
                             at_once=1 << 21)
    return encode


class SharedModel:
    """The model's arrays as one broadcast; bounded by the vocabulary."""

    def __init__(self, spark: SparkSession, path: str):
        self.fields = spark.sparkContext.broadcast(vars(load_model(path)))

    @property
    def value(self) -> PieceModel:
        return shared(self.fields.value, "model", lambda: PieceModel(**self.fields.value))

    @property
    def encoder(self):
        """An encoder whose word caches end with the task."""
        return encoder(self.value)


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "piece_ids") -> DataFrame:
    """The documents with their own columns and the piece ids of the text."""
    base = without(docs, ids_col)
    model, at = SharedModel(docs.sparkSession, model_path), base.columns.index(text_col)
    schema = T.StructType(base.schema.fields + [T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches):
        encode_all = model.encoder
        for whole in batches:
            texts = whole.column(at).cast(pa.binary())
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
            for begin, rows in by_bytes(sizes, 1 << 21):  # ids take more room than text
                null = texts.slice(begin, rows).is_null()
                arrays = list(encode_all(pc.fill_null(texts.slice(begin, rows), b"")))
                ends = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).view(np.int32)),
                                               mask=null)
                yield pa.RecordBatch.from_arrays([*whole.slice(begin, rows).columns, ids],
                                                 names=schema.fieldNames())

    return in_arrow(base, run, schema)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "piece_ids",
           text_col: str = "decoded") -> DataFrame:
    """The rows with the text of their piece ids; null ids give null."""
    base = without(encoded, text_col)
    model, at = SharedModel(encoded.sparkSession, model_path), base.columns.index(ids_col)
    schema = T.StructType(base.schema.fields + [T.StructField(text_col, T.StringType())])

    def run(batches):
        pieces = model.value
        for batch in batches:
            texts = [None if x is None else
                     decode_ids(pieces, np.array(x, np.int64)).decode("utf-8", "replace")
                     for x in (v.as_py() for v in batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=schema.fieldNames())

    return in_arrow(base, run, schema)


def round_trips(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, ids_crc32 (little-endian unsigned 32-bit ids),
    round_trip (decoding gives the text again)."""
    model = SharedModel(docs.sparkSession, model_path)
    work = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("data"))

    def make():
        pieces = model.value
        encode_all = model.encoder
        is_byte = np.zeros(len(pieces.score), bool)
        is_byte[pieces.byte_id[pieces.byte_id >= 0]] = True

        def each(batch: pa.RecordBatch) -> dict:
            texts = batch.column(1)
            out = {"n_pieces": [], "n_byte_pieces": [], "ids_crc32": [], "round_trip": []}
            for x, ids in zip(texts, encode_all(texts)):
                out["n_pieces"].append(len(ids))
                out["n_byte_pieces"].append(int(is_byte[ids].sum()))
                out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                out["round_trip"].append(decode_ids(pieces, ids) == x.as_py())
            return {"doc_id": batch.column(0), **out}
        return each

    return map_arrow(work, make, "doc_id BIGINT, n_pieces BIGINT, n_byte_pieces BIGINT, "
                                 "ids_crc32 BIGINT, round_trip BOOLEAN")


def op1_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    if model_path is None:
        import public_tokenizers
        model_path = public_tokenizers.path("piece_bpe_32k.model")
    return round_trips(read_table(spark, sf_dir, "documents"), model_path)
