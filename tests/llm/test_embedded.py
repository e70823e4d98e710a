"""op5: passages inside longer lines and across short ones."""

import random

from actiflow.llm import embedded, paragraphs

TABLE = "doc_id BIGINT, text STRING"


def new(rng, n):
    return [f"aé{rng.randrange(10**9)}" for _ in range(n)]


def test_embedded_passages_are_found_and_clean_texts_are_not(spark):
    rng = random.Random(2)
    rows, sharing = [], set()
    for k in range(200):
        said = new(rng, 51 + k % 40)
        for doc in (2 * k, 2 * k + 1):
            words = new(rng, rng.randrange(20, 60)) + said + new(rng, rng.randrange(20, 60))
            if doc % 4 == 1:  # the passage wrapped, with capitals (of ASCII letters)
                words = [w.replace("a", "A") for w in words]
                text = "\n".join(" ".join(words[i:i + 11]) for i in range(0, len(words), 11))
            else:
                text = " ".join(words)
            rows.append((doc, text))
            sharing.add(doc)
    rows += [(1000 + k, " ".join(new(rng, 90))) for k in range(200)]
    got = paragraphs.repeated_text(spark.createDataFrame(rows, TABLE)).collect()
    found = {r.doc_id for r in got}
    assert found <= sharing and len(found) >= 0.97 * len(sharing)
    texts = dict(rows)
    by_class = {}
    for r in got:
        assert r.embedded
        words = texts[r.doc_id][r.start:r.end].lower().split()
        assert len(words) == r.n_words == 20
        by_class.setdefault(tuple(words), []).append(r)
    for same in by_class.values():
        assert len(same) == 2 and sorted(r.removed for r in same) == [False, True]
        assert {r.class_doc_id for r in same} == {min(r.doc_id for r in same)}


def test_cuts_depend_on_near_words_only():
    rng = random.Random(3)
    cutter = embedded.Cutter()
    said = new(rng, 200)
    alone = cutter.cut([" ".join(said).encode()])
    both = cutter.cut([b"", " ".join(new(rng, 30) + said).encode(), b"x", " ".join(said + new(rng, 5)).encode()])
    inside = set(zip(alone["a"], alone["b"]))
    for text in (1, 3):
        other = set(zip(both["a"][both["text"] == text], both["b"][both["text"] == text]))
        assert len(inside & other) >= len(inside) - 2  # all but those next to an end
    assert not len(cutter.cut([b""])["a"]) and not len(cutter.cut([b"a b c", b"d " * 19])["a"])
    assert not len(cutter.cut([b"same " * 500])["a"])  # no place is the least


def test_offsets_and_line_numbers():
    rng = random.Random(4)
    cutter = embedded.Cutter()
    texts = ["\n".join(" ".join(new(rng, 7)) for _ in range(12)), " é\n" + " ".join(new(rng, 80))]
    found = cutter.cut([t.encode() for t in texts])
    assert set(found["text"]) == {0, 1}
    for t, p, a, b, mid in zip(*(found[c].tolist() for c in ("text", "paragraph", "start", "end", "mid"))):
        assert len(texts[t][a:b].split()) == 20 and a <= mid < b
        assert texts[t][:mid].count("\n") == p and texts[t][a] != " " and texts[t][b - 1] != " "


def test_small_cases(spark):
    rng = random.Random(6)
    said = " ".join(new(rng, 120))
    rows = [(None, "a " + said), (None, "b " + said), (7, "c " + said), (7, "d " + said), (8, None), (9, ""),
            (10, "q " + said), (10, "q " + said)]
    got = paragraphs.repeated_text(spark.createDataFrame(rows, TABLE)).collect()
    # Long lines with one word changed are near paragraphs; so nothing embedded is left to find.
    assert len(got) == 6 and not any(r.embedded for r in got) and sum(not r.removed for r in got) == 1
    work = paragraphs.keyed(spark.createDataFrame(rows, TABLE), "doc_id", "text").selectExpr(
        "doc_id", "text_id", "CASE WHEN doc_id IS NULL THEN monotonically_increasing_id() END AS row", "data")
    none = spark.createDataFrame([], "text_id BIGINT, start BIGINT, `end` BIGINT")
    units = embedded.repeated_units(work, none).collect()
    firsts = [r for r in units if not r.removed]
    assert {r.doc_id for r in firsts} == {7} and {r.class_doc_id for r in units} == {7}
    assert len(units) == 6 * len(firsts) and sum(r.doc_id is None for r in units) == 2 * len(firsts)
    assert paragraphs.repeated_text(spark.createDataFrame([], TABLE)).count() == 0
    clash = spark.createDataFrame([(1, said, 1, 2, "x"), (2, said, 3, 4, "y")], TABLE + ", a INT, start INT, row STRING")
    assert paragraphs.repeated_text(clash).count() == 2
