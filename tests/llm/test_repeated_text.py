"""op5 on rows without ids, repeated ids, wrapped lines and embedded passages."""

from actiflow.llm import paragraphs


def test_paragraphs_of_null_and_repeated_ids(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    near_a, near_b = a.replace("a30", "other"), b.replace("b30", "other")
    # Several texts without id and under one id, each first seen at paragraph 0.
    for i in (None, 7):
        texts = [(i, a), (i, b), (9 if i else None, near_a), (9 if i else None, near_b)]
        got = paragraphs.repeated_paragraphs(spark.createDataFrame(texts, "doc_id BIGINT, text STRING")).collect()
        assert len(got) == 4 and sum(r.removed for r in got) == 2
    # Exact copies without id, and one line that starts two texts of an id.
    texts = [(None, a)] * 3 + [(7, f"{b}\nx"), (7, f"{b}\ny")]
    got = paragraphs.repeated_paragraphs(spark.createDataFrame(texts, "doc_id BIGINT, text STRING")).collect()
    assert sorted((r.doc_id or 0, r.removed) for r in got) == [(0, False), (0, True), (0, True), (7, False), (7, True)]


def test_blocks_of_short_lines(spark):
    words = [f"w{i}" for i in range(60)]
    wrapped = "\n".join(" ".join(words[i:i + 10]) for i in range(0, 60, 10))
    texts = [(1, " ".join(words)), (2, wrapped), (3, "head\n\n" + wrapped + "\n\ntail"), (4, "that it."), (5, "That  it."),
             (6, "other"), (7, "x y\n\nz"), (8, "x y\nz"), (9, " \n\t"), (10, None)]
    table = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    got = {(r.doc_id, r.paragraph, r.start, r.end, r.class_doc_id, r.removed)
           for r in paragraphs.repeated_blocks(table).collect()}
    n = len(wrapped)
    assert got == {(1, 0, 0, n, 1, False), (2, 0, 0, n, 1, True), (3, 2, 6, 6 + n, 1, True), (4, 0, 0, 8, 4, False),
                   (5, 0, 0, 9, 4, True), (7, 0, 0, 6, 7, False), (8, 0, 0, 5, 7, True)}
