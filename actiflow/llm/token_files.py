"""Token ids in files: frequency-ranked, byte-aligned variable-length codes.

1. Texts are encoded once (chunk by chunk, see ``chunks``); the ids of each document are
   kept, compressed, in a stored table.
2. Ids are ranked by how often they occur in the whole corpus, so frequent ids get small
   numbers. The ranks are one row per vocabulary entry that occurs: bounded by the
   vocabulary, whatever the corpus.
3. Documents go to ranges of doc_id (one a task, of equal size) and are sorted there. Each range is written as chunks
   of whole documents: per id a number of 1 to 4 bytes in the ``data`` stream and its
   length in two bits of the separate ``control`` stream, four ids to a control byte.
4. Readers decode a chunk with numpy: one table lookup gives four lengths per control byte.

The files are Parquet tables (``chunks``, ``ranks``) whose binary columns hold the
streams, so that every file system Spark writes to can hold them.

Defined cases: null text counts as empty and has only the end id; a null doc_id comes
after all others; rows with one doc_id are ordered by the crc32 of their ids; an empty
table gives empty files; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from actiflow.llm.chunks import ChunkCache, WordCache, encode_column, shared
from actiflow.llm.common import in_arrow, map_arrow, stored, text_bytes
from actiflow.session import work_root
from actiflow.sources.tables import read_table

END_ID = 2
IDS_PER_CHUNK = 1 << 18
SLICE = 1 << 20  # bytes of a long text split at once

# A space between two other characters: no piece of a byte-level vocabulary whose
# splitting pattern keeps a space with the word after it crosses the place before it.
_PLAIN = re.compile(r"\s\s")
# The same for Arrow's expressions, and white space at an end, or nothing.
_WHITE = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
          r"\x{202f}\x{205f}\x{3000}]")
_PLAIN_RE2 = _WHITE + "{2}"
_EDGE_RE2 = f"^{_WHITE}|{_WHITE}$|^$"
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
# Ends of matches inside a word, for the splitting pattern of ``ByteLevel`` (GPT-2): a letter
# before ASCII other than letters, and anything else before a line feed. Only Latin letters,
# which all versions of Unicode agree on; other places are just not cut.
_LETTER = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]"
_PART_ENDS = [f"({_LETTER})([\\n!-@\\[-`{{-~])", r"([^\x00\t-\r ])(\n)"]
_APART = " a"  # such an end lies on either side of it



def split_text(text: str) -> Iterator[list[str]]:
    """Lists of chunks; joined they are the text, and each list is of bounded size
    unless a stretch without such a space is longer."""
    at = 0
    while True:
        cut = _BETWEEN.search(text, at + SLICE) if len(text) - at > SLICE else None
        part = text[at:cut.start()] if cut else text[at:]
        if _PLAIN.search(part):
            words = _BETWEEN.split(part)
            yield [words[0], *[" " + w for w in words[1:]]] if words[0] else []
        else:
            words = part.split(" ")
            yield [words[0], *[" " + w for w in words[1:]]] if words[0] else [" " + w for w in words[1:]]
        if not cut:
            return
        at = cut.start()


class ByteEncoder:
    """Encodes chunks with a byte-level tokenizer of the tokenizers library."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        # A piece of a byte-level vocabulary has one character per byte of text.
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        for piece, i in vocab.items():
            self.bytes_of[i] = len(piece)
        self.parts, self.apart = None, self.ids(_APART)
        model = json.loads(tokenizer_json)
        self.added = "|".join(["\\x00", *[_quoted(t["content"]) for t in model.get("added_tokens") or []]])
        if _cuts_at_letters(model):
            self.parts = WordCache(self._parts, max_words=200_000, max_ids=1_600_000)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks and how many each has. Chunks of the form space, word are
        encoded many at a time as one text and cut apart by their bytes; others one by one."""
        out: list = [None] * len(chunks)
        run: list[int] = []
        size = 0
        for k, c in enumerate(chunks):
            if c[:1] == " " and not c[-1:].isspace():
                run.append(k)
                size += len(c)
                if size > 1 << 14:
                    self._together(chunks, run, out)
                    run, size = [], 0
            else:
                out[k] = self.ids(c)
        self._together(chunks, run, out)
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def _together(self, chunks: list[str], run: list[int], out: list) -> None:
        if not run:
            return
        ids, sizes = self._cut("".join([chunks[k] for k in run]),
                               np.array([len(chunks[k].encode()) for k in run]))
        if ids is None:
            # Some id crosses a cut: halves, so that only chunks near it are encoded alone.
            half = len(run) // 2
            if half:
                self._together(chunks, run[:half], out)
                self._together(chunks, run[half:], out)
            else:
                out[run[0]] = self.ids(chunks[run[0]])
            return
        ends = [0, *np.cumsum(sizes).tolist()]
        for k, a, b in zip(run, ends, ends[1:]):
            out[k] = ids[a:b]

    def _cut(self, text: str, lengths: np.ndarray):
        """Ids of the text, and how many belong to each stretch of bytes; (None, None) if
        an id crosses from one to the next."""
        ids = self.ids(text)
        at, ends = np.cumsum(self.bytes_of[ids]), np.cumsum(lengths)
        cuts = np.searchsorted(at, ends)
        if not len(at) or at[-1] != ends[-1] or not np.array_equal(at[cuts], ends):
            return None, None
        return ids, np.diff(cuts, prepend=-1)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each with a space in front, and how many each has."""
        odd = pc.match_substring_regex(words, _EDGE_RE2).to_numpy(zero_copy_only=False)
        if odd.any():  # at the end of a text only
            return self([" " + w for w in words.to_pylist()])
        spaced = pc.binary_join_element_wise("", words, " ")
        if self.parts is None or pc.any(pc.match_substring_regex(words, self.added)).as_py():
            return self._run(spaced)
        for ends in _PART_ENDS:
            spaced = pc.replace_substring_regex(spaced, ends, "\\1\x00\\2")
        split = pc.split_pattern(spaced, "\x00")
        coded = split.flatten().dictionary_encode()
        ids, sizes = self.parts.ids_of(coded.dictionary, coded.indices.to_numpy())
        offsets = split.offsets.to_numpy()
        return ids, np.add.reduceat(sizes, offsets[:-1] - offsets[0])

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts of words, and how many each has; ``_APART`` keeps those without a space
        in front from what is before them."""
        follows = pc.invert(pc.starts_with(parts, " "))
        texts = pc.if_else(follows, pc.binary_join_element_wise(_APART, parts, ""), parts)
        ids, sizes = self._run(texts)
        follows = follows.to_numpy(zero_copy_only=False)
        own = np.ones(len(ids), bool)
        skip = (np.cumsum(sizes) - sizes)[follows]
        own[(skip[:, None] + np.arange(len(self.apart))).ravel()] = False
        return ids[own], sizes - len(self.apart) * follows

    def _run(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks that the tokenizer keeps apart, many at a time as one text."""
        lengths = pc.binary_length(chunks).to_numpy()
        bounds = np.append(np.arange(0, len(chunks), 2000), len(chunks)).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), chunks), "").to_pylist()
        ids, sizes = [], []
        for text, a, b in zip(joined, bounds, bounds[1:]):
            one, counts = self._cut(text, lengths[a:b])
            if one is None:
                one, counts = self(chunks[a:b].to_pylist())
            ids.append(one)
            sizes.append(counts)
        return np.concatenate(ids), np.concatenate(sizes).astype(np.int64)


def _quoted(text: str) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in text)


def _cuts_at_letters(model: dict) -> bool:
    """Whether a tokenizer splits by the ``ByteLevel`` pattern, which never looks back, and has no
    other rule that could see across the ends of ``_PART_ENDS``."""
    before = model.get("pre_tokenizer") or {}
    return (model.get("normalizer") is None and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before.get("add_prefix_space", True)
            and not any(re.search(r"^[^\W\d_]|\s|^$", t["content"]) or t["lstrip"] or t["rstrip"]
                        or t["single_word"] for t in model.get("added_tokens") or []))


def encode_documents(docs: DataFrame, tokenizer_json: str, end_id: int = END_ID,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_ids, crc, ids): ids with the end id, as compressed little-endian
    unsigned 32-bit integers."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast({"json": tokenizer_json})  # bounded by the vocabulary
    work = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("data"))

    def make():
        encoder = shared(model.value, "encoder", lambda: ByteEncoder(model.value["json"]))
        cache = shared(model.value, "chunks", lambda: ChunkCache(encoder))
        words = shared(model.value, "words", lambda: WordCache(encoder.words))
        pack = zstandard.ZstdCompressor(level=1)
        end = np.array([end_id], np.uint32)

        def each(batch: pa.RecordBatch) -> dict:
            n, crc, packed = [], [], []
            texts = as_strings(batch.column(1))
            plain = ~pc.match_substring_regex(texts, _PLAIN_RE2).to_numpy(zero_copy_only=False)
            for ids in encode_column(texts, plain, split_text, cache, words, bare_first=True):
                ids = np.concatenate([ids, end])
                n.append(len(ids))
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                packed.append(pack.compress(planes(ids)))
            return {"doc_id": batch.column(0), "n_ids": n, "crc": crc, "ids": packed}
        return each

    return map_arrow(work, make, "doc_id BIGINT, n_ids BIGINT, crc BIGINT, ids BINARY")


def as_strings(data: pa.Array) -> pa.Array:
    try:
        return data.cast(pa.string())
    except pa.ArrowInvalid:  # not UTF-8: replacement characters
        return pa.array([x.as_py().decode("utf-8", "replace") for x in data], pa.string())


def planes(ids: np.ndarray) -> bytes:
    """16-bit ids where they fit, else 32-bit, with a leading byte that tells."""
    small = not len(ids) or int(ids.max()) < 1 << 16
    return (b"\x02" if small else b"\x04") + ids.astype("<u2" if small else "<u4").tobytes()


def unpacker():
    """Compressed planes -> ids; one decompressor per task."""
    decompress = zstandard.ZstdDecompressor().decompress

    def unpacked(data: bytes) -> np.ndarray:
        raw = decompress(data)
        return np.frombuffer(raw, "<u2" if raw[0] == 2 else "<u4", offset=1)
    return unpacked


def id_ranks(encoded: DataFrame) -> DataFrame:
    """(id, n, rank): ids by falling frequency in the whole corpus, ties by id."""
    def counts(batches):
        total, held, size = np.zeros(1 << 16, np.int64), [], 0
        unpacked = unpacker()

        def counted():
            nonlocal total
            found = np.bincount(np.concatenate(held) if held else np.zeros(0, np.int64), minlength=len(total))
            found[:len(total)] += total
            total = found
            held.clear()

        for batch in batches:
            for x in batch.column(0):
                held.append(unpacked(x.as_py()))
                size += len(held[-1])
                if size > 1 << 20:
                    counted()
                    size = 0
        counted()
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())],
                                         names=["id", "n"])

    summed = in_arrow(encoded.select("ids"), counts, "id BIGINT, n BIGINT").groupBy("id").agg(
        F.sum("n").alias("n"))
    # One row per vocabulary entry at most.
    order = Window.orderBy(F.col("n").desc(), F.col("id"))
    return summed.withColumn("rank", (F.row_number().over(order) - 1).cast("bigint"))


def encode_stream(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit numbers."""
    ranks = ranks.astype(np.uint32)
    extra = (ranks > 0xFF).view(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    ends = np.cumsum(extra + np.uint8(1), dtype=np.int64)
    starts = ends - extra - 1
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    data[starts] = ranks.astype(np.uint8)
    for k in range(1, int(extra.max()) + 1 if len(extra) else 1):
        long = np.nonzero(extra >= k)[0]
        data[starts[long] + k] = (ranks[long] >> np.uint32(8 * k)).astype(np.uint8)
    four = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    four[:len(ranks)] = extra
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


# Lengths of the four numbers that a control byte describes.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1).astype(np.uint8)


def decode_stream(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    raw = np.frombuffer(data, np.uint8)
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    out = raw[starts].astype(np.uint32)
    for k in range(1, int(lengths.max()) if n else 1):
        long = np.nonzero(lengths > k)[0]
        out[long] |= raw[starts[long] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


CHUNK_SCHEMA = ("range INT, first BIGINT, n_docs BIGINT, n_ids BIGINT, doc_ids BINARY, "
                "doc_nulls BINARY, doc_sizes BINARY, control BINARY, data BINARY")


def write_token_files(encoded: DataFrame, path: str, ids_per_chunk: int = IDS_PER_CHUNK,
                      ranges: int | None = None) -> None:
    """Write ``encoded`` (a stored table) to ``path``/ranks and ``path``/chunks."""
    spark = encoded.sparkSession
    id_ranks(encoded).write.parquet(path + "/ranks")
    table = rank_table(spark, path, by="id", value="rank")
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Ranges of equal size by sampled bounds; rows without an id come last and rows of one id
    # are told apart, so they too are split over tasks.
    order = [F.col("doc_id").asc_nulls_last(), F.col("crc"), F.col("n_ids"), F.col("row")]
    sorted_rows = (encoded.select("doc_id", "n_ids", "crc", "ids", F.monotonically_increasing_id().alias("row"))
                   .repartitionByRange(n, *order).sortWithinPartitions(*order)
                   .select(F.spark_partition_id().alias("range"), "doc_id", "n_ids", "ids"))

    def pack(batches):
        rank_of, unpacked = table.value, unpacker()
        state = {"range": None, "first": 0}
        docs: list = []

        def chunk():
            ids = [unpacked(x) for _, x in docs]
            control, data = encode_stream(rank_of[np.concatenate(ids)])
            total = sum(map(len, ids))
            row = [state["range"], state["first"], len(docs), total,
                   np.array([d or 0 for d, _ in docs], "<i8").tobytes(),
                   np.packbits([d is None for d, _ in docs]).tobytes(),
                   np.array(list(map(len, ids)), "<u4").tobytes(), control, data]
            state["first"] += total
            docs.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, CHUNK_TYPES)],
                                              names=CHUNK_NAMES)

        held = 0
        for batch in batches:
            for where, doc, n_ids, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if docs and (where != state["range"] or held >= ids_per_chunk):
                    yield chunk()
                    held = 0
                if where != state["range"]:
                    state["range"], state["first"] = where, 0
                docs.append((doc, ids))
                held += n_ids
        if docs:
            yield chunk()

    in_arrow(sorted_rows, pack, CHUNK_SCHEMA).write.option("compression", "zstd").parquet(path + "/chunks")


CHUNK_NAMES = [x.split()[0] for x in CHUNK_SCHEMA.split(", ")]
CHUNK_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 5]


def rank_table(spark: SparkSession, path: str, by: str, value: str):
    """The ranks as a broadcast array; one entry per vocabulary entry."""
    rows = spark.read.parquet(path + "/ranks").select(by, value).toPandas()
    table = np.zeros(int(rows[by].max()) + 1 if len(rows) else 1, np.uint32)
    table[rows[by].to_numpy()] = rows[value].to_numpy()
    return spark.sparkContext.broadcast(table)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids): start counts the ids of all documents
    before; ids are little-endian unsigned 32-bit integers, left out if not wanted."""
    table = rank_table(spark, path, by="rank", value="id")
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path + "/chunks")

    def make():
        id_of = table.value

        def each(batch: pa.RecordBatch) -> dict:
            out = {c: [] for c in ("range", "doc_id", "at", "n_tokens", "ids_crc32", "ids")}
            for row in batch.to_pylist():
                ids = id_of[decode_stream(row["control"], row["data"], row["n_ids"])].astype("<u4")
                sizes = np.frombuffer(row["doc_sizes"], "<u4").astype(np.int64)
                ends = np.cumsum(sizes)
                nulls = np.unpackbits(np.frombuffer(row["doc_nulls"], np.uint8), count=row["n_docs"])
                docs = np.frombuffer(row["doc_ids"], "<i8").tolist()
                out["range"] += [row["range"]] * len(docs)
                out["doc_id"] += [None if x else d for d, x in zip(docs, nulls)]
                out["at"] += (row["first"] + ends - sizes).tolist()
                out["n_tokens"] += sizes.tolist()
                parts = [ids[b - s:b] for b, s in zip(ends.tolist(), sizes.tolist())]
                out["ids_crc32"] += [zlib.crc32(x) for x in parts]
                out["ids"] += [x.tobytes() if with_ids else None for x in parts]
            return out
        return each

    docs = map_arrow(chunks, make, "range INT, doc_id BIGINT, at BIGINT, n_tokens BIGINT, "
                                   "ids_crc32 BIGINT, ids BINARY")
    # One row per range: at most the number of shuffle partitions of the writer.
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.groupBy(F.col("range").alias("of")).agg(F.sum("n_ids").alias("n")).select(
        "of", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return docs.join(F.broadcast(starts), F.col("range") == F.col("of")).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
        *(["ids"] if with_ids else []))


def token_files(docs: DataFrame, tokenizer_json: str, path: str, end_id: int = END_ID,
                id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode the documents and write their ids under ``path``."""
    encoded = stored(encode_documents(docs, tokenizer_json, end_id, id_col, text_col), "token_ids")
    write_token_files(encoded, path)
    return path


def op7_token_files(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer_path, encoding="utf-8") as f:
        model = f.read()
    path = token_files(read_table(spark, sf_dir, "documents"), model, work_root(spark, "token_files"))
    return read_token_files(spark, path, with_ids=False)
