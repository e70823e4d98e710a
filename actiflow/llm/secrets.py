"""Secret scans: keyword prefilter, anchored expressions near hits, checksum validation.

1. One Aho-Corasick pass over the ASCII-lower-cased text finds all keyword hits. Runs of
   hex digits have no keyword; their prefilter looks for 24 hex characters in a row in the
   text mapped to two symbols.
2. Only at a hit is the rule's expression tried, anchored there.
3. Rules with embedded checks are validated: package and repository tokens carry a CRC32
   of their body in base 62, web tokens a header that must decode.

Defined cases: null text counts as empty and has no spans; a null doc_id stays null;
repeated rows each give a row; an empty table gives an empty result; bytes that are not
UTF-8 count as one replacement character each; extra columns are ignored by ``find_secrets``
and kept by ``redact``.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actiflow.llm.common import PREFIX, in_arrow, map_arrow, text_bytes
from actiflow.sources.tables import read_table

# Fixed values of the base rules: expressions and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
# Added rules, public formats: prefix, 30 characters, 6 base-62 digits of their CRC32.
CHECKED = {"repo": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
           "package": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")}
WEB = re.compile(r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
KINDS = ["assign", "access", "hex", "repo", "package", "web"]
BASE_KINDS = KINDS[:3]
KEYWORDS = {"assign": ["password", "passwd", "secret", "token", "apikey", "api_key"],
            "access": ["akia"], "repo": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"],
            "package": ["npm_"], "web": ["eyj"]}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_MAP = bytes(0x31 if chr(i) in "0123456789abcdef" else 0x30 for i in range(256))

Span = tuple[int, int, int, int]  # start, rank of kind, end, start of the secret value


def base62_crc(body: str) -> str:
    n, out = zlib.crc32(body.encode()), ""
    while n:
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out.rjust(6, "0")


def valid_header(token: str) -> bool:
    head = token.split(".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, binascii.Error, TypeError):
        return False


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def scan(data: bytes, keywords: ahocorasick.Automaton) -> list[Span]:
    """Spans of one text by start, then kind; positions are code points."""
    text = data.decode("utf-8", "replace")
    lower = data.lower().decode("utf-8", "replace")
    spans: list[Span] = []
    open_from = dict.fromkeys(KINDS, 0)  # matches of one kind do not overlap
    hits = sorted((end - size + 1, kind) for end, (kind, size) in keywords.iter(lower))
    for at, kind in hits:
        if at < open_from[kind]:
            continue
        rule = {"assign": ASSIGN, "access": ACCESS, "web": WEB}.get(kind) or CHECKED[kind]
        m = rule.match(text, at)
        if not m:
            continue
        open_from[kind] = m.end()
        if kind == "assign":
            good, value = len(m[2]) >= MIN_VALUE, m.start(2)
        elif kind == "access":
            good, value = len(m[0]) >= MIN_ACCESS, at
        elif kind == "web":
            good, value = valid_header(m[0]), at
        else:
            good, value = base62_crc(m[1]) == m[2], at
        if good:
            spans.append((at, KINDS.index(kind), m.end(), value))
    if data.translate(HEX_MAP).find(b"1" * MIN_HEX) >= 0:
        spans += [(m.start(), KINDS.index("hex"), m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(spans)



def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans array<struct<kind, start, end, value_start>> by start, then kind."""
    work = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("data"))

    def make():
        keywords = automaton()

        def each(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column(0),
                    "spans": [[{"kind": KINDS[k], "start": a, "end": b, "value_start": v}
                               for a, k, b, v in scan(x.as_py(), keywords)] for x in batch.column(1)]}
        return each

    return map_arrow(work, make, "doc_id BIGINT, spans ARRAY<STRUCT<kind: STRING, start: INT, "
                                 "`end`: INT, value_start: INT>>")


def redacted(data: bytes, spans: list[Span]) -> str:
    """The text with every secret value replaced; overlapping values become one mark."""
    text, out, at = data.decode("utf-8", "replace"), [], 0
    for value, end, kind in sorted((v, b, k) for _, k, b, v in spans):
        if value >= at:
            out += [text[at:value], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The documents with their own columns, secrets in the text replaced by ``<kind>``;
    ``length_col`` is set to the new text's length. Null texts stay null."""
    columns, at = docs.columns, len(docs.columns)

    def run(batches):
        keywords = automaton()
        for batch in batches:
            arrays = list(batch.columns[:at])
            changed = {}
            for i, x in enumerate(batch.column(at)):
                data = x.as_py()
                if data:
                    spans = scan(data, keywords)
                    if spans:
                        changed[i] = redacted(data, spans)
            if changed:
                k = columns.index(text_col)
                texts = arrays[k].to_pylist()
                for i, text in changed.items():
                    texts[i] = text
                arrays[k] = pa.array(texts, arrays[k].type)
                if length_col:
                    k = columns.index(length_col)
                    sizes = arrays[k].to_pylist()
                    for i, text in changed.items():
                        sizes[i] = len(text)
                    arrays[k] = pa.array(sizes, arrays[k].type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return in_arrow(docs.withColumn(PREFIX + "data", text_bytes(text_col)), run, docs.schema)


def digest(spans_col: str = "spans") -> dict:
    """The result columns of the query, from an array of spans."""
    def text(keep):
        return F.concat_ws(",", F.transform(
            F.filter(spans_col, lambda s: s["kind"].isin(*keep)),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    def of(kind):
        return F.filter(spans_col, lambda s: s["kind"] == kind)
    count = {f"n_{k}": F.size(of(k)).cast("bigint") for k in BASE_KINDS}
    return count | {"base_sha256": F.sha2(text(BASE_KINDS).cast("binary"), 256),
                    "spans_text": text(KINDS)}


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents"))
    cols = digest()
    return found.select("doc_id", *[c.alias(n) for n, c in cols.items() if n != "spans_text"],
                        cols["spans_text"].alias("spans"))
