"""op5_passages: no run of 51 words is left twice, by brute force."""

import random

from actiflow.llm import paragraphs, queries
from conftest import SF_SMALL


def pieces_left(text, spans):
    """Words of the stretches of a text between its removed spans."""
    ends = [0] + [b for _, b in spans]
    starts = [a for a, _ in spans] + [len(text)]
    return [text[a:b].encode().lower().split() for a, b in zip(ends, starts)]


def windows(words):
    return [tuple(words[i:i + 51]) for i in range(len(words) - 50)]


def removed_spans(rows):
    spans = {}
    for r in sorted(rows, key=lambda r: r.start):
        spans.setdefault(r.doc_id, []).append((r.start, r.end))
    return spans


def check(texts, spans):
    """Nothing of 51 words is left in two documents."""
    seen = {}
    for i, text in texts.items():
        for words in pieces_left(text, spans.get(i, [])):
            for w in windows(words):
                assert seen.setdefault(w, i) == i
    return len(seen)


def test_embedded_passages(spark):
    rng = random.Random(4)
    new = lambda n: [f"aé{rng.randrange(10**9)}" for _ in range(n)]
    said, short = new(60), new(50)
    line = lambda a, p, b: " ".join(new(a) + p + new(b))
    texts = {1: line(300, said, 200), 2: line(100, said, 500), 3: line(7, [w.replace("a", "A") for w in said], 9) + "\nx",
             4: line(30, short, 30), 5: line(90, short, 2), 6: " ".join(new(70)),
             7: " ".join(new(5)) + " " + "\n".join(" ".join(said[k:k + 12]) for k in range(0, 60, 12))}
    table = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    spans = removed_spans(paragraphs.repeated_passages(table).collect())
    assert sorted(spans) == [2, 3, 7]
    for i in spans:
        (a, b), = spans[i]
        assert texts[i][a:b].lower().split() == said
    check(texts, spans)


def test_runs_within_one_text_and_without_ids(spark):
    rng = random.Random(5)
    new = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    twice, copy = new(55), "\n\n".join(new(15) for _ in range(6)) + "\n\n" + new(25)
    rows = [(1, f"{new(30)} {twice} {new(3)} {twice} {new(30)}"), (2, "x " * 500), (None, copy), (None, copy), (None, copy)]
    table = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = paragraphs.repeated_passages(table).collect()
    at = rows[0][1].rindex(twice)
    assert [(r.start, r.end) for r in got if r.doc_id == 1] == [(at, at + len(twice))]
    assert [(r.start, r.end) for r in got if r.doc_id == 2] == [(102, 999)]
    assert [(r.repeat, r.start, r.end) for r in got if r.doc_id is None] == [(True, 0, len(copy))]
    assert paragraphs.repeated_passages(table.limit(0)).count() == 0


def test_no_run_is_left_twice(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    spans = removed_spans(queries.QUERIES["op5_passages"](spark, SF_SMALL).collect())
    assert check(texts, spans) > 1000
