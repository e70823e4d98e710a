"""op2: the place in reply order, against a plain walk of random threads with quotes."""

import random

from actiflow.llm import quotes

CONV = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def walk(parents):
    """Places of a depth-first walk, answers by turn."""
    answers, places, stack = {}, {}, []
    for turn, parent in sorted(parents.items()):
        answers.setdefault(parent, []).append(turn)
    stack = answers.get(None, [])[::-1]
    while stack:
        turn = stack.pop()
        places[turn] = len(places)
        stack += answers.get(turn, [])[::-1]
    return places


def test_tour_against_a_walk(spark):
    rng = random.Random(8)
    trees, rows = {}, []
    for conv in range(30):
        turns = sorted(rng.sample(range(-5, 20_000), rng.randrange(1, 40)))  # over several blocks of turns
        parents = {t: None if not i else rng.choice(turns[max(0, i - rng.choice([1, 5, 40])):i]) for i, t in enumerate(turns)}
        trees[conv] = walk(parents)
        rows += [(conv, t, p) for t, p in parents.items()]
    rows += [(99, t, t - 1 if t else None) for t in range(300)] + [(98, t, 0 if t else None) for t in range(300)]
    trees[99] = trees[98] = {t: t for t in range(300)}
    got = quotes.tour_places(spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, parent_turn BIGINT")).collect()
    assert len(got) == len(rows) and all(trees[r.conv_id][r.turn] == r.place for r in got)


def test_threads_with_nested_quotes(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for conv in range(25):
        said, text, parents = [], [], {}
        for t in range(rng.randrange(1, 12)):
            own = f"Message {t} of {conv} says {rng.randrange(10**9)}."
            target = rng.randrange(t) if t and rng.random() < 0.6 else None
            quote = ""
            if target is not None:  # with what the message quoted, one level deeper
                quote = "Someone wrote:\n" + "\n".join("> " + line for line in text[target].split("\n")) + "\n\n"
            said.append(own)
            text.append(quote + own)
            parents[t] = target if target is not None else (t - 1 if t else None)
            rows.append((conv, t, "user", text[t]))
        for t, place in walk(parents).items():
            want[conv, t] = (place, parents[t], said[t])
    got = quotes.reply_order(spark.createDataFrame(rows, CONV)).collect()
    assert {(r.conv_id, r.turn): (r.position, r.parent_turn, r.text) for r in got} == want
    assert any(place != t for (_, t), (place, _, _) in want.items())


def test_without_branches_the_order_is_that_of_turns(spark):
    rows = [(1, t, "user", f"text {t}") for t in (3, 5, 9, 4100, 9000)] + [(2, None, "user", "x"), (None, 1, "user", "y")]
    got = {(r.conv_id, r.turn): r.position for r in quotes.reply_order(spark.createDataFrame(rows, CONV)).collect()}
    assert got == {(1, 3): 0, (1, 5): 1, (1, 9): 2, (1, 4100): 3, (1, 9000): 4, (2, None): None, (None, 1): None}
    assert quotes.reply_order(spark.createDataFrame([], CONV)).count() == 0
