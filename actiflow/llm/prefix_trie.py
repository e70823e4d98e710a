"""Prefix trie of conversations, built as burst tries.

Conversations hang in containers under trie heads, at first all under the root. A container
of more than ``limit`` turns bursts by the next turn id: its head becomes a node, and each
next turn a head with a container of its own. Containers that fit are dealt to tasks, sorted
and swept into nodes in one pass over neighbours' common prefixes. A container with one
conversation is a chain and needs no sweep, however long it is. The sums of a burst head come
from the tops of its children's subtrees, level by level from the deepest.

A round of bursting costs one stored table, so the number of rounds is the length of the
longest prefix that more than one conversation of an oversized container shares. Turn ids and
heads are 128-bit prefixes of SHA-256 digests, a head's of its parent head and turn.

Turns are numbered by range-sorted partitions, sums are pre-aggregated, joins by head or
conversation are plain sort-merge joins whose hot keys Spark splits. The digest of the
conversations that end at a burst head runs over packed runs of ids in order, a run per task
and head, so no task holds a group of them.

Defined cases: null role or text becomes empty; turns are ordered by turn, nulls first, then
by role and by the digest of role and text; rows without a conversation take no part;
repeated rows are turns of their own; ``conv_id % 100`` keeps the sign of conv_id; an absent
head conversation lends no turns; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actiflow.llm.common import in_arrow, map_groups, stored
from actiflow.llm.ordering import numbered
from actiflow.sources.tables import read_table

# Fixed values of the contract: conversations share the first turns of the one whose id is
# a multiple of GROUP, as many as the crc32 of the own id modulo HEADS.
GROUP = 100
HEADS = 6
# Method parameter: turns (with one end mark each conversation) a container may hold.
LIMIT = 128

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
NODE = ("head STRING, up STRING, conv_id BIGINT, depth BIGINT, parent_conv_id BIGINT, n_convs BIGINT, "
        "n_children BIGINT, n_leaves BIGINT, saved_tokens BIGINT, ends_sha256 STRING")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           "ends_sha256"]


def digest(col: Column) -> Column:
    return F.substring(F.sha2(col, 256), 1, 32)


def sequences(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: turns (conv, pos from 1, turn, points) with an end mark (null
    turn) behind the last, and one row (conv, left = number of those rows) each; stored."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").alias("nr"), role.alias("role"),
        digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("turn"),
        F.char_length(text).cast("bigint").alias("points"))
    rows = numbered(rows, [F.col("conv"), F.col("nr").asc_nulls_first(), F.col("role"), F.col("turn")],
                    "number").drop("nr", "role")
    lengths = rows.groupBy("conv").agg(F.min("number").alias("start"), F.count(F.lit(1)).alias("n"))
    lent = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    convs = lengths.select("conv", "start", "n", lent.alias("h"), (F.col("conv") - F.col("conv") % GROUP).alias("base"))
    bases = convs.filter(F.col("conv") == F.col("base")).select(F.col("conv").alias("of"), F.col("n").alias("has"),
                                                               F.col("start").alias("base_start"))
    convs = stored(convs.join(bases, F.col("base") == F.col("of"), "left").withColumn(
        "taken", F.least("h", F.coalesce("has", F.lit(0)))).withColumn(
        "left", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)) + 1), "trie_conversations")
    # At most GROUP - 1 conversations take at most HEADS - 1 turns each from one base.
    first = rows.join(bases, F.col("conv") == F.col("of")).withColumn("rank", F.col("number") - F.col("base_start"))
    first = first.filter(F.col("rank") < HEADS - 1).select("of", "rank", "turn", "points")
    borrowed = convs.select("conv", "base", "h").join(
        first, (F.col("base") == F.col("of")) & (F.col("rank") < F.col("h"))).select(
        "conv", (F.col("rank") + 1).alias("pos"), "turn", "points")
    own = rows.join(convs.select(F.col("conv").alias("c"), "start", "h", "taken"), F.col("conv") == F.col("c"))
    rank = F.col("number") - F.col("start")
    own = own.filter(rank >= F.col("h")).select(
        "conv", (rank - F.col("h") + F.col("taken") + 1).alias("pos"), "turn", "points")
    ends = convs.select("conv", F.col("left").alias("pos"), F.lit(None).cast("string").alias("turn"),
                        F.lit(0).cast("bigint").alias("points"))
    turns = stored(borrowed.unionByName(own).unionByName(ends), "trie_turns")
    return turns, convs.select("conv", "left")


def sweeper():
    """Worker side: whole containers -> their nodes."""
    import hashlib as hashes

    def sweep(conversations, out, head, up, depth, points):
        """conversations: sorted (turns, conv, points of the turns); all start at the head."""
        def node(d, p):
            return {"d": d, "conv": None, "n": 0, "children": 0, "leaves": 0, "saved": 0, "p": p, "ends": [], "below": []}

        def close(x, parent):
            leaves = x["leaves"] if x["children"] else 1
            saved = x["saved"] + (x["n"] - 1) * x["p"]
            at = len(out["conv_id"])
            sha = hashes.sha256(",".join(map(str, sorted(x["ends"]))).encode()).hexdigest()
            for name, value in (("head", None), ("up", None), ("conv_id", x["conv"]), ("depth", x["d"]),
                                ("parent_conv_id", None), ("n_convs", x["n"]), ("n_children", x["children"]),
                                ("n_leaves", leaves), ("saved_tokens", saved), ("ends_sha256", sha)):
                out[name].append(value)
            for row in x["below"]:
                out["parent_conv_id"][row] = x["conv"]
            if parent is None:
                out["head"][at], out["up"][at] = head, up
                return
            parent["children"] += 1
            parent["leaves"] += leaves
            parent["saved"] += saved
            parent["n"] += x["n"]
            parent["conv"] = x["conv"] if parent["conv"] is None else min(parent["conv"], x["conv"])
            parent["below"].append(at)

        stack, before = [node(depth, points)], []
        for turns, conv, sizes in conversations:
            same = 0
            while same < len(before) and same < len(turns) and before[same] == turns[same]:
                same += 1
            while len(stack) > same + 1:
                close(stack.pop(), stack[-1])
            for i in range(same, len(turns)):
                stack.append(node(depth + i + 1, sizes[i]))
            end = stack[-1]
            end["ends"].append(conv)
            end["n"] += 1
            end["conv"] = conv if end["conv"] is None else min(end["conv"], conv)
            before = turns
        while len(stack) > 1:
            close(stack.pop(), stack[-1])
        close(stack.pop(), None)

    def groups(table: pa.Table, bounds):
        out = {n: [] for n in ("head", "up", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                               "n_leaves", "saved_tokens", "ends_sha256")}
        cols = table.to_pydict()
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            found = {}
            for i in sorted(range(lo, hi), key=cols["pos"].__getitem__):
                turns, sizes = found.setdefault(cols["conv"][i], ([], []))
                if cols["turn"][i] is not None:
                    turns.append(cols["turn"][i])
                    sizes.append(cols["points"][i])
            sweep(sorted((t, c, p) for c, (t, p) in found.items()), out, cols["head"][lo], cols["up"][lo],
                  cols["depth"][lo], cols["last"][lo])
        return out

    return groups


def end_digests(ended: DataFrame) -> DataFrame:
    """(of, ends_sha256): digest of the ids that end at each head, in ascending order.

    Range-sorted partitions pack the ids of a head into runs of text; the digest of a head
    then streams over its runs, of which one task holds one at a time."""
    n = int(ended.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs: list[tuple[str, int, list]] = []
            for head, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not runs or runs[-1][0] != head:
                    runs.append((head, conv, []))
                runs[-1][2].append(conv)
            if runs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in runs]), pa.array([r[1] for r in runs], pa.int64()),
                     pa.array([",".join(map(str, r[2])) for r in runs])], names=["of", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_head, state = None, None
        for batch in batches:
            heads, shas = [], []
            for head, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if head != open_head:
                    if state is not None:
                        heads.append(open_head)
                        shas.append(state.hexdigest())
                    open_head, state = head, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if heads:
                yield pa.RecordBatch.from_arrays([pa.array(heads), pa.array(shas)], names=["of", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([open_head]), pa.array([state.hexdigest()])],
                                             names=["of", "ends_sha256"])

    packed = in_arrow(ended.repartitionByRange(n, "head", "conv").sortWithinPartitions("head", "conv"), pack,
                      "of STRING, first BIGINT, ids STRING")
    return in_arrow(packed.repartition(n, "of").sortWithinPartitions("of", "first"), hashed,
                    "of STRING, ends_sha256 STRING")


def trie(turns: DataFrame, convs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Nodes of the trie over ``sequences`` (columns of the contract)."""
    # The root's head is empty text, but no literal: a join by a literal would have no key.
    first = convs.select(F.col("conv"), F.substring(F.col("conv").cast("string"), 1, 0).alias("head"), F.lit(None).cast("string").alias("up"),
                         F.lit(0).cast("bigint").alias("last"), "left")
    levels = []
    while True:
        sizes = first.groupBy("head").agg(F.count(F.lit(1)).alias("n"), F.sum("left").alias("held"))
        oversized = (F.col("n") > 1) & (F.col("held") > limit)
        level = stored(first.join(sizes.select(F.col("head").alias("of"), "n", oversized.alias("big")),
                                  F.col("head") == F.col("of")).drop("of"), "trie_level")
        levels.append(level)
        if not level.filter("big").limit(1).count():
            break
        # The next turn of every conversation of an oversized container opens a head.
        depth = len(levels)
        following = turns.filter((F.col("pos") == depth) & F.col("turn").isNotNull()).select(
            F.col("conv").alias("whose"), "turn", "points")
        first = level.filter("big").join(following, F.col("conv") == F.col("whose")).select(
            "conv", digest(F.concat("head", "turn")).alias("head"), F.col("head").alias("up"),
            F.col("points").alias("last"), (F.col("left") - 1).alias("left"))

    kept = reduce(DataFrame.unionByName, [
        x.filter("not big").select("conv", "head", "up", "last", "n", F.lit(d).cast("bigint").alias("depth"))
        for d, x in enumerate(levels)])
    suffixes = turns.withColumnRenamed("conv", "whose").join(
        kept, (F.col("whose") == F.col("conv")) & (F.col("pos") > F.col("depth")))
    swept = map_groups(suffixes.filter("n > 1").select("head", "up", "depth", "last", "conv", "pos", "turn", "points"),
                       ["head"], sweeper, NODE)
    # A lone conversation: the row behind a node's last turn is one of its suffix.
    top = F.col("pos") == F.col("depth") + 1
    leaf = F.col("turn").isNull()
    chains = suffixes.filter("n = 1").select(
        F.when(top, F.col("head")).alias("head"), F.when(top, F.col("up")).alias("up"), F.col("conv").alias("conv_id"),
        (F.col("pos") - 1).alias("depth"), F.when(~top, F.col("conv")).alias("parent_conv_id"),
        F.lit(1).cast("bigint").alias("n_convs"), F.when(leaf, 0).otherwise(1).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(leaf, F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(F.lit(EMPTY_SHA))
        .alias("ends_sha256"))
    nodes = stored(swept.unionByName(chains), "trie_nodes")

    # Heads that burst, from the deepest level up.
    heads = []
    for d in range(len(levels) - 2, -1, -1):
        own = levels[d].filter("big").groupBy("head").agg(
            F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("up").alias("up"),
            F.first("last").alias("last"))
        below = nodes.filter(F.col("up").isNotNull() & (F.col("depth") == d + 1))
        if heads:
            below = below.unionByName(heads[-1].filter(F.col("up").isNotNull()), allowMissingColumns=True)
        sums = below.groupBy(F.col("up").alias("of")).agg(
            F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("below"))
        heads.append(stored(own.join(sums, F.col("head") == F.col("of"), "left").select(
            "head", "up", "conv_id", F.lit(d).cast("bigint").alias("depth"),
            F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
            (F.coalesce("below", F.lit(0)) + (F.col("n_convs") - 1) * F.col("last")).alias("saved_tokens")),
            "trie_heads"))
    if not heads:
        return nodes.select(*COLUMNS)
    burst = reduce(DataFrame.unionByName, heads)
    ended = reduce(DataFrame.unionByName, [x.filter("big and left = 1").select("head", "conv") for x in levels[:-1]])
    burst = burst.join(end_digests(ended), F.col("head") == F.col("of"), "left").drop("of").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))
    # The parent of a subtree's top is a burst head; all others know theirs.
    parents = reduce(DataFrame.unionByName, [x.select(F.col("head").alias("of"), F.col("conv_id").alias("above"))
                                             for x in heads])
    tops = nodes.filter(F.col("up").isNotNull()).unionByName(burst.filter(F.col("up").isNotNull()))
    tops = tops.join(parents, F.col("up") == F.col("of")).withColumn("parent_conv_id", F.col("above"))
    others = nodes.filter(F.col("up").isNull()).unionByName(burst.filter(F.col("up").isNull()))
    return tops.select(*COLUMNS).unionByName(others.select(*COLUMNS))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(*sequences(read_table(spark, sf_dir, "conversations")))


# The crc32 of ASCII digits, bit by bit: a step of 0 or more takes in a byte, a step of -1 shifts.
OP12_SQL = """
WITH RECURSIVE o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
           substr(sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS nr
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
           string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) ELSE xor(a >> 1, (a & 1) * 3988292384) END),
           4294967295) % 6 AS h
  FROM o GROUP BY conv_id
), turns AS (
  SELECT c.conv_id, 0 AS part, o.nr, role, text FROM c JOIN o ON o.conv_id = c.base AND o.nr <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.nr, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND o.nr > c.h
), s AS (
  SELECT c.conv_id, coalesce(t.path, []) AS path, coalesce(t.sizes, []) AS sizes
  FROM c LEFT JOIN (SELECT conv_id, list(sha256(strlen(role)::VARCHAR || ':' || role || text) ORDER BY part, nr) AS path,
                           list(length(text) ORDER BY part, nr) AS sizes FROM turns GROUP BY conv_id) t USING (conv_id)
), p AS (
  SELECT conv_id, path[1:d] AS prefix, d, len(path) = d AS ends, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS points
  FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM s)
), n AS (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(points) AS saved,
         sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM p GROUP BY prefix, d
), k AS (
  SELECT n.*, coalesce(ch.children, 0) AS n_children, up.conv_id AS parent_conv_id
  FROM n LEFT JOIN (SELECT prefix[1:d - 1] AS prefix, count(*) AS children FROM n WHERE d > 0 GROUP BY ALL) ch
           ON ch.prefix = n.prefix
         LEFT JOIN n up ON n.d > 0 AND up.prefix = n.prefix[1:n.d - 1]
), sub AS (
  SELECT prefix[1:e] AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
         sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM k) GROUP BY ALL
)
SELECT k.conv_id, k.d::BIGINT AS depth, k.parent_conv_id, k.n_convs, k.n_children, sub.n_leaves, sub.saved_tokens,
       k.ends_sha256
FROM k JOIN sub USING (prefix)
"""
