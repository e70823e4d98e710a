"""Prefix trie: burst and unburst containers against a plain dictionary of prefixes."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from actiflow.llm import prefix_trie, queries
from actiflow.llm.prefix_trie import COLUMNS, sequences, trie
from conftest import SF_SMALL

TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0), role, digest(role, text), text))
    own = {c: [(r, t) for _, r, _, t in sorted(x)] for c, x in own.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c - 100 * int(c / 100))
        rebuilt[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, x in rebuilt.items():
        for d in range(len(x) + 1):
            members[tuple(x[:d])].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        saved[p] = sum(saved[c] for c in children[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(df, limit):
    return sorted((tuple(r) for r in trie(*sequences(df), limit=limit).select(*COLUMNS).collect()), key=str)


def rows_of_many_kinds():
    rows = []
    for c in list(range(0, 130)) + [200, 205, 301, -5, -205, 10**12]:
        for t in range((c * 7) % 9):
            # A common first turn, copies, and turns of their own.
            text = "hello" if t == 0 else f"{c % 3}:{t}" if c % 4 else f"{c}:{t}"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    rows += [(700, None, None, None), (700, 3, "user", "é🙂"), (700, None, "a", "b"), (None, 0, "user", "lost")]
    rows += [(701, 0, "user", "twice")] * 2 + [(702, 0, "use", "rx"), (703, 0, "user", "x")]
    rows += [(800, t, "user", "long %d" % t) for t in range(300)] + [(801, 0, "user", "short")]
    return rows


@pytest.mark.parametrize("limit", [2, 25, 10**9])
def test_brute_force(spark, limit):
    rows = rows_of_many_kinds()
    assert nodes(spark.createDataFrame(rows, TURNS), limit) == plain(rows)


def test_copies_burst_to_their_end(spark):
    rows = [(100 * c, t, "user", f"turn {t}") for c in range(1, 400) for t in range(4)]
    rows += [(100 * c, t, "user", f"turn {t} of {c}") for c in range(400, 440) for t in range(3)]
    assert nodes(spark.createDataFrame(rows, TURNS), 32) == plain(rows)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op12_prefix_trie"](spark, SF_SMALL)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


def test_end_digests_stream_over_runs(spark):
    ended = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("head"),
                                       (F.col("id") - 500).alias("conv"))
    got = {r.of: r.ends_sha256 for r in prefix_trie.end_digests(ended).collect()}
    for head, own in (("a", lambda i: i % 3 == 0), ("b", lambda i: i % 3)):
        ids = ",".join(str(i - 500) for i in range(20_000) if own(i))
        assert got[head] == hashlib.sha256(ids.encode()).hexdigest()


def test_small_cases(spark):
    none = spark.createDataFrame([], TURNS)
    assert nodes(none, 2) == []
    assert nodes(spark.createDataFrame([(None, 0, "user", "x")], TURNS), 2) == []
    clash = spark.createDataFrame([(5, 0, "user", "x", 1, "h", 3)], TURNS + ", pos INT, head STRING, n_convs INT")
    assert nodes(clash, 2) == plain([(5, 0, "user", "x")])
