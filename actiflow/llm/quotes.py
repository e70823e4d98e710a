"""Quotation linking: conversations in reply order, without quotes.

1. A line's quote level is the number of ``>`` marks before its text. Runs of lines of one
   level, cut at blank lines, are passages. What a message says itself are its level-0
   lines, without the attribution line in front of a quote.
2. Passages are normalised (lower case, single spaces, signs at the ends dropped) and
   hashed. Quoted passages, and their lines, are joined with the own passages and lines of
   earlier messages of the conversation; the latest earlier one counts.
3. A message answers the message that most of its level-1 passages come from (ties: the
   later one); without such a link it answers the message before it. Deeper levels give
   links too; ``branch`` is the turn where a new line of replies starts.
4. The position is the place in reply order: a message, then its answers by turn, each with
   all that answers it. In a conversation without a branch that is the order of turns. Where
   there are branches, places are ranks in a tour of the tree (each message is entered, its
   answers follow, it is left), found by doubling: a table per round, as many rounds as the
   logarithm of the longest conversation with branches.

Quotes are linked with earlier messages only: an original cannot come after its quote.

The latest earlier original is found with running maxima in blocks of turns that are
carried over from block to block, so neither a long conversation nor a common passage is
gathered in one task, and no pairs are made.

Defined cases: null text counts as empty; rows with a null conv_id or turn keep their own
text but have no position, parent or links; rows with one (conv_id, turn) share their
position and parent, and quotes of all of them vote; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from actiflow.llm.common import map_arrow, stored
from actiflow.operators.blocks import previous_value
from actiflow.sources.tables import read_table

BLOCK_TURNS = 4096
_MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
_ATTRIBUTION = re.compile(r".*\b(wrote|writes|said)\b[^\n]*:\s*$", re.IGNORECASE)
_ENDS = " \t\r.,;:!?\"'()[]*-"


def levels(text: str) -> list[tuple[int, str]]:
    """(quote level, text) of every line."""
    out = []
    for line in text.split("\n"):
        m = _MARKS.match(line)
        out.append((m[1].count(">"), line[m.end():].strip()) if m else (0, line.rstrip("\r")))
    return out


def normalised(text: str) -> str:
    return " ".join(text.lower().split()).strip(_ENDS)


def passage_hash(text: str) -> int | None:
    text = normalised(text)
    if not text:
        return None
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))
    return h - (1 << 64) if h >= 1 << 63 else h


def parsed(text: str) -> tuple[str, list[tuple[int, int, int]]]:
    """The message's own text, and (level, passage number, hash) of all passages and lines."""
    lines = levels(text)
    kept = [(level, line) for i, (level, line) in enumerate(lines)
            if level or not (_ATTRIBUTION.match(line) and i + 1 < len(lines) and lines[i + 1][0])]
    units, runs = [], []
    for level, line in kept:
        if not line.strip():
            runs.append((level, []))
        elif runs and runs[-1][0] == level and runs[-1][1]:
            runs[-1][1].append(line)
        else:
            runs.append((level, [line]))
    for number, (level, run) in enumerate(r for r in runs if r[1]):
        texts = {" ".join(run), *run}
        units += [(level, number, h) for h in {passage_hash(t) for t in texts} if h is not None]
    return "\n".join(line for level, line in kept if not level).strip(), sorted(units)


def parse_messages(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, own text and units (level, passage, hash) of every message."""
    work = messages.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
                           F.col("role").cast("string"), F.coalesce("text", F.lit("")).cast("string").alias("text"))

    def make():
        def each(batch: pa.RecordBatch) -> dict:
            found = [parsed(x) for x in batch.column(3).to_pylist()]
            return {"conv_id": batch.column(0), "turn": batch.column(1), "role": batch.column(2),
                    "own_text": [t for t, _ in found],
                    "units": [[{"level": a, "passage": b, "hash": h} for a, b, h in u] for _, u in found]}
        return each

    return map_arrow(work, make, "conv_id BIGINT, turn BIGINT, role STRING, own_text STRING, "
                                 "units ARRAY<STRUCT<level: INT, passage: INT, hash: BIGINT>>")


def carried_max(rows: DataFrame, group: list[str], order: list, value: Column, name: str) -> DataFrame:
    """Adds the largest ``value`` of all earlier rows of the group by ``turn`` and ``order``
    (the row itself included), by blocks of turns whose maxima are carried on."""
    work = rows.withColumn("_value", value).withColumn("_block", F.floor(F.col("turn") / BLOCK_TURNS))
    inside = Window.partitionBy(*group, "_block").orderBy("turn", *order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    tails = work.groupBy(*group, "_block").agg(F.max("_value").alias("_tail"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    tails = tails.withColumn("_carried", F.max("_tail").over(before)).drop("_tail")
    return (work.withColumn("_inside", F.max("_value").over(inside))
            .join(tails, [*group, "_block"])
            .withColumn(name, F.greatest("_inside", "_carried"))
            .drop("_value", "_block", "_inside", "_carried"))


def quote_links(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, target (turn), passages: for every quote level of a message
    the earlier message that most of its passages come from. ``messages``: parsed, stored."""
    units = (messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
             .select("conv_id", "turn", F.explode("units").alias("u"))
             .select("conv_id", "turn", "u.level", "u.passage", "u.hash").distinct())
    quotes = units.filter("level > 0")
    wanted = quotes.select("conv_id", "hash").distinct()
    originals = units.filter("level = 0").join(wanted, ["conv_id", "hash"], "left_semi")
    # Quotes come before originals of the same turn, so a message never quotes itself.
    found = carried_max(quotes.union(originals.select(quotes.columns)), ["conv_id", "hash"],
                        [F.col("level").desc()], F.when(F.col("level") == 0, F.col("turn")), "target")
    # A passage found whole or by its lines counts once for each message it comes from.
    votes = (found.filter("level > 0 AND target IS NOT NULL")
             .groupBy("conv_id", "turn", "level", "target")
             .agg(F.countDistinct("passage").alias("passages")))
    return votes.groupBy("conv_id", "turn", "level").agg(
        F.max_by("target", F.struct("passages", "target")).alias("target"), F.max("passages").alias("passages"))


def tour_places(tree: DataFrame) -> DataFrame:
    """(conv_id, turn, place): place of every message (from 0) in the tour of its reply tree.
    ``tree``: conv_id, turn, parent_turn (null for the root)."""
    key = ["conv_id", "turn"]
    # The answer before, to the same message; blocks keep much-answered messages from one task.
    siblings = previous_value(tree.withColumn("of", F.struct("conv_id", "parent_turn")), "of", ["turn"],
                              F.floor(F.col("turn") / BLOCK_TURNS), "turn", "before").drop("of")
    siblings = stored(siblings, "siblings")
    following = siblings.filter("before IS NOT NULL").select(
        "conv_id", F.col("before").alias("turn"), F.col("turn").alias("next_sibling"))
    first = siblings.filter("parent_turn IS NOT NULL").groupBy(
        "conv_id", F.col("parent_turn").alias("turn")).agg(F.min("turn").alias("first_answer"))
    linked = siblings.join(following, key, "left").join(first, key, "left")
    # A step of the tour is twice the turn (the message is entered) or one more (it is left).
    enter, leave = F.col("turn") * 2, F.col("turn") * 2 + 1
    steps = linked.select("conv_id", F.explode(F.array(
        F.struct(enter.alias("step"), F.coalesce(F.col("first_answer") * 2, leave).alias("next"), F.lit(1).alias("left")),
        F.struct(leave.alias("step"), F.coalesce(F.col("next_sibling") * 2, F.col("parent_turn") * 2 + 1).alias("next"),
                 F.lit(0).alias("left")))).alias("s")).select("conv_id", "s.step", "s.next",
                                                              F.col("s.left").cast("long").alias("left"))
    while True:  # ``left`` counts the messages entered from a step on, up to ``next``
        steps = stored(steps, "tour")
        if not steps.filter("next IS NOT NULL").limit(1).count():
            break
        ahead = steps.select("conv_id", F.col("step").alias("next"), F.col("next").alias("after"), F.col("left").alias("more"))
        steps = steps.join(ahead, ["conv_id", "next"], "left").select(
            "conv_id", "step", F.col("after").alias("next"), (F.col("left") + F.coalesce("more", F.lit(0))).alias("left"))
    entered = steps.filter("step % 2 = 0")
    whole = entered.groupBy("conv_id").agg(F.max("left").alias("whole"))
    return entered.join(whole, "conv_id").select(
        "conv_id", F.floor(F.col("step") / 2).cast("long").alias("turn"), (F.col("whole") - F.col("left")).alias("place"))


def reply_order(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, position, parent_turn, by_quote, branch, n_quoted, n_links,
    text (without quotes): one row per message."""
    parsed_rows = stored(parse_messages(messages), "messages")
    links = stored(quote_links(parsed_rows), "quote_links")
    turns = (parsed_rows.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
             .select("conv_id", "turn").distinct())
    # Position and previous turn in blocks of turns; counts and last turns are carried on.
    block = F.floor(F.col("turn") / BLOCK_TURNS)
    inside = Window.partitionBy("conv_id", "_b").orderBy("turn")
    before = Window.partitionBy("conv_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    blocked = turns.withColumn("_b", block)
    tails = (blocked.groupBy("conv_id", "_b").agg(F.count(F.lit(1)).alias("n"), F.max("turn").alias("last"))
             .select("conv_id", "_b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skipped"),
                     F.max("last").over(before).alias("last")))
    placed = (blocked.withColumn("at", F.row_number().over(inside)).withColumn("prev", F.lag("turn").over(inside))
              .join(tails, ["conv_id", "_b"])
              .select("conv_id", "turn", (F.col("skipped") + F.col("at") - 1).alias("position"),
                      F.coalesce("prev", "last").alias("prev")))
    counts = links.groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("level") == 1, F.col("target"))).alias("quoted"), F.count(F.lit(1)).alias("n_links"))
    tree = (placed.join(counts, ["conv_id", "turn"], "left")
            .withColumn("parent_turn", F.coalesce("quoted", "prev")))
    tree = stored(tree, "reply_tree")
    branched = tree.filter("quoted <> prev").select("conv_id").distinct()
    order = tour_places(tree.join(branched, "conv_id", "left_semi").select("conv_id", "turn", "parent_turn")) \
        .withColumnRenamed("place", "_place")
    tree = tree.join(order, ["conv_id", "turn"], "left").withColumn("position", F.coalesce("_place", "position"))
    starts = F.col("prev").isNull() | (F.col("quoted") != F.col("prev"))
    tree = carried_max(tree, ["conv_id"], [], F.when(starts, F.col("turn")), "branch").select(
        F.col("conv_id").alias("c"), F.col("turn").alias("t"), "position", "parent_turn",
        F.col("quoted").isNotNull().alias("by_quote"), "branch", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    n_quoted = F.size(F.array_distinct(F.transform(
        F.filter("units", lambda u: u["level"] > 0), lambda u: u["passage"]))).cast("bigint")
    return (parsed_rows.join(tree, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
            .select("conv_id", "turn", "role", "position", "parent_turn", "by_quote", "branch",
                    n_quoted.alias("n_quoted"), "n_links", F.col("own_text").alias("text")))


def op2_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_order(read_table(spark, sf_dir, "conversations"))
