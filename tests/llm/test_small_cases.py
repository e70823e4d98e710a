"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from actiflow.llm import (mixing, neighbours, paragraphs, pieces, quality_rules, quotes, secrets,
                          simhash, token_files, topk)

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
WORDS = " ".join(f"word{i}" for i in range(60))
NEAR = WORDS.replace("word30", "other")
EXTRA = ", score DOUBLE, kept BOOLEAN, size STRING, fp STRING, spans STRING, piece_ids STRING, h INT, component_id INT"


def rows():
    texts = [(1, WORDS, "a"), (2, WORDS, "b"), (3, NEAR, "a"), (4, None, None), (5, "", "a"),
             (None, "a b", "b"), (6, "x " * 20000 + "end", "c"), (7, " \t\n ", "a"),
             (8, "é🙂 token=abcdef1 " + WORDS[::-1], None), (1, WORDS, "a")]
    return [(i, t, "en", s, len(t or "")) for i, t, s in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def clashing(spark):
    extra = (1.0, True, "s", "f", "p", "q", 1, 2)
    return spark.createDataFrame([r + extra for r in rows()], DOCS + EXTRA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 1), (6, 0), (7, None), (None, 0), (3, 1), (3, 0)],
                                 "doc_id BIGINT, quality INT")


@pytest.fixture(scope="module")
def piece_path():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_quality(docs, none, clashing):
    got = quality_rules.judge(docs)
    assert got.count() == len(rows())
    by = {r.doc_id: r for r in got.collect()}
    assert by[4].n_words == 0 and by[4].base_failed and by[4].host is None
    assert by[6].n_words == 20001 and by[6].n_repeat_words == 20000 and by[6].base_failed
    assert by[1].n_words == 60 and not by[1].base_failed
    assert quality_rules.judge(none).count() == 0
    same(quality_rules.judge(clashing).select(*got.columns), got)
    kept = quality_rules.keep_good(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 1, 2, 3, 8]
    assert quality_rules.keep_good(none).count() == 0


def test_host_verdict(spark):
    good = [(i, " ".join(f"w{i}x{j}" for j in range(30)), "en", "fine", 1) for i in range(40)]
    bad = [(100 + i, "no", "en", "poor", 1) for i in range(39)] + [(139, good[0][1], "en", "poor", 1)]
    kept = quality_rules.keep_good(spark.createDataFrame(good + bad, DOCS))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(40))
    verdict = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(good + bad, DOCS)).collect()}
    assert not verdict[139].base_failed and not verdict[139].kept


@pytest.mark.parametrize("text,n", [("", 0), ("a b c d e", 0), ("a b c d e a b c d e", 10),
                                    ("a a a a a a", 6), ("a b c d e f a b c d e", 10)])
def test_repeated_words(text, n):
    words = text.encode().split()
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 5)}
    assert quality_rules.repeated_words(words) == len(covered) == n


def test_simhash(docs, none, clashing):
    got = simhash.near_duplicates(docs)
    by = {(r.doc_id, r.fp): r.component_id for r in got.collect()}
    assert got.count() == len(rows())
    assert {by[k] for k in by if k[0] in (1, 2)} == {1}
    assert {by[k] for k in by if k[0] in (4, 5, 7)} == {4}
    assert simhash.near_duplicates(none).count() == 0
    left = simhash.drop_near_duplicates(clashing)
    assert left.columns == clashing.columns
    ids = [r.doc_id for r in left.collect()]
    assert len(ids) == len(set(ids)) and 1 in ids and 2 not in ids and 5 not in ids and 4 in ids
    assert None in ids
    assert simhash.drop_near_duplicates(none).count() == 0


def test_secrets(docs, none, clashing):
    text = "é🙂 token=abcdef1 " + WORDS[::-1]
    got = {r.doc_id: r.spans for r in secrets.find_secrets(docs).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[8]] == [("assign", 3, 16)]
    assert got[4] == [] and got[5] == []
    assert secrets.find_secrets(none).count() == 0
    clean = {r.doc_id: r for r in secrets.redact(clashing, length_col="n_chars").collect()}
    assert clean[8].text == text.replace("abcdef1", "<assign>") and clean[8].n_chars == len(clean[8].text)
    assert clean[4].text is None and clean[1].text == WORDS
    assert secrets.redact(none).count() == 0


CHECKED = "a1B2c3D4e5" * 3
SAMPLES = ["token=abc password=abcdefg", "token=token:abcdefgh", 'API_KEY: "abcdef"', "ſecret=abcdef", "AKIA" + "A" * 15,
           "AKIA" + "A" * 16, "xAKIAAKIA" + "B" * 14, "0" * 23 + "g" + "a" * 24, "secret = = abcdef",
           "token='abc.def-/+=' apikey=123456", "ghp_" + CHECKED + secrets.base62_crc(CHECKED),
           "ghp_" + CHECKED + "000000", "npm_" + CHECKED + secrets.base62_crc(CHECKED), "password" * 3 + "=abcdef"]


@pytest.mark.parametrize("text", SAMPLES)
def test_secret_rules_equal_plain_search(text):
    spans = secrets.scan(text.encode(), secrets.automaton())
    base = [(m.start(), 0, m.end()) for m in secrets.ASSIGN.finditer(text) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end()) for m in secrets.ACCESS.finditer(text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    assert [s[:3] for s in spans if s[1] < 3] == sorted(base)
    checked = [secrets.KINDS[s[1]] for s in spans if s[1] >= 3]
    assert checked == (["repo"] if text[:4] == "ghp_" and text[-6:] != "000000" else
                       ["package"] if text[:4] == "npm_" else [])


def test_redaction_of_overlaps():
    text = "token=" + "ab12" * 8 + " rest"
    spans = secrets.scan(text.encode(), secrets.automaton())
    assert len(spans) == 2 and secrets.redacted(text.encode(), spans) == "token=<assign> rest"


def test_mixing(spark, docs, none, clashing):
    got = mixing.with_copies(docs)
    by = {r.source: r for r in got.collect()}
    assert got.count() == len(rows())
    total = sum(r[1] and len(r[1].split()) or 0 for r in rows())
    assert sum(r.target for r in by.values()) == pytest.approx(total)
    assert all(r.target <= 3 * r.source_size for r in by.values())
    assert all(0 <= r.copies <= 3 for r in got.collect())
    assert mixing.with_copies(none).count() == 0 and mixing.mix(none).count() == 0
    mixed = mixing.mix(clashing)
    assert mixed.columns == clashing.columns
    assert mixed.count() == got.agg({"copies": "sum"}).first()[0]
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, mixing.mix(docs).collect()))


def test_token_files(spark, docs, none, clashing, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = f.read()
    plain = tokenizers.Tokenizer.from_str(model)
    for k, table in enumerate((docs, clashing)):
        path = token_files.token_files(table, model, f"file://{tmp_path}/{k}")
        got = token_files.read_token_files(spark, path).orderBy("start").collect()
        ids = [r.doc_id for r in got]
        assert ids == [1, 1, 2, 3, 4, 5, 6, 7, 8, None]
        texts = {i: t or "" for i, t, *_ in rows()}
        at = 0
        for r in got:
            expected = plain.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
            assert np.frombuffer(r.ids, "<u4").tolist() == expected
            assert (r.start, r.n_tokens) == (at, len(expected))
            at += len(expected)
    path = token_files.token_files(none, model, f"file://{tmp_path}/none")
    assert token_files.read_token_files(spark, path).count() == 0


def plain_ids(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


def test_token_chunks_equal_whole_texts(monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers
    from actiflow.llm.chunks import ChunkCache, WordCache, encode_column, encode_texts
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = f.read()
    plain_model = tokenizers.Tokenizer.from_str(model)
    texts = ["", " ", "x\u00a0\u2003y z", "a\x1c\x1fb c", "  ", " a", "a ", "a  b", "a\n b \n", " x y  z", "it's 'quoted' \t tab", "a" * 999,
             "one two  three\n\nfour five ", "日本 語", "\n".join(f"w{i} x" for i in range(50)), WORDS]
    for size in (1 << 20, 7):
        monkeypatch.setattr(token_files, "SLICE", size)
        for limit in (1_000_000, 3):
            cache = ChunkCache(token_files.ByteEncoder(model), max_chunks=limit)
            plain = ~pc.match_substring_regex(pa.array(texts), token_files._PLAIN_RE2).to_numpy(zero_copy_only=False)
            for at_once in (1, 20, 1 << 20):
                words = WordCache(token_files.ByteEncoder(model).words, max_words=limit)
                got = [x.tolist() for k in range(2)
                       for x in encode_column(pa.array(texts), plain, token_files.split_text, cache, words,
                                              True, at_once)][len(texts):]
                assert got == [plain_ids(plain_model, t) for t in texts]
            for at_once in (1, 100):
                got = [x.tolist() for x in encode_texts(texts, token_files.split_text, cache, at_once)]
                assert got == [plain_ids(plain_model, t) for t in texts]


def test_new_words_are_encoded_by_parts_seen_before(monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = f.read()
    whole = tokenizers.Tokenizer.from_str(model)
    encoder, sent, plain = token_files.ByteEncoder(model), [], token_files.ByteEncoder.ids
    monkeypatch.setattr(token_files.ByteEncoder, "ids", lambda self, text: sent.append(text) or plain(self, text))

    def check(words):
        ids, sizes = encoder.words(pa.array(words))
        ends = np.cumsum(sizes)
        assert [ids[b - n:b].tolist() for b, n in zip(ends, sizes)] == [plain_ids(whole, " " + w) for w in words]

    check(["Straße", "haus", "it's", "x.", "y,", "end.\nNext", "end.\nMore"])
    sent.clear()
    check(["Straße.", "haus,", "haus's", "it.", "end,", "haus.\nNext", "end's.\nMore"])
    assert not sent  # all parts are known
    check(["'", "''s", "a'b'll", "..a..b", "a1b2.c3", "日本.a", "×.", "a×.b", "a\tb.c", "ʰ.", "e\u0301.x", "-", "a-\n-b",
           "a_b", "\U0001f600.a", "http://a.b/c?d=1", "x\ny\nz", "A.B.C."])
    check(["a.b", "a<|endoftext|>b", "c\x00d", "e,f"])


def test_streams_round_trip():
    numbers = np.array([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 7, 9], np.uint32)
    for n in range(len(numbers) + 1):
        control, data = token_files.encode_stream(numbers[:n])
        assert len(control) == -(-n // 4)
        assert token_files.decode_stream(control, data, n).tolist() == numbers[:n].tolist()


def test_pieces(docs, none, clashing, piece_path):
    got = pieces.encode(clashing, piece_path)
    assert got.columns == [c for c in clashing.columns if c != "piece_ids"] + ["piece_ids"]
    back = pieces.decode(got, piece_path).collect()
    assert all(r.decoded == r.text for r in back)
    by = {r.doc_id: r.piece_ids for r in back}
    assert by[4] is None and by[5] == []
    assert all(r.round_trip for r in pieces.round_trips(docs, piece_path).collect())
    assert pieces.encode(none, piece_path).count() == 0


def best_score(model, keys, text):
    """Plain Viterbi over characters."""
    best = [0.0] + [-np.inf] * len(text)
    for i in range(len(text)):
        if text[i:i + 1] not in keys:
            best[i + 1] = max(best[i + 1], best[i] + model.unknown)
        for j in range(i + 1, min(len(text), i + 30) + 1):
            if text[i:j] in keys:
                best[j] = max(best[j], best[i] + keys[text[i:j]])
    return best[-1]


def test_pieces_reach_the_best_score(piece_path, monkeypatch):
    model = pieces.load_model(piece_path)
    starts = model.ends
    data = model.pool.tobytes()
    keys = {data[a:b].decode(): model.score[i] for i, (a, b) in enumerate(zip(starts[:-1], starts[1:]))
            if b > a and i not in set(model.byte_id.tolist())}
    texts = ["hello world", "the  end", "日本語テキスト 🙂🙂", "a\tb\nc", "x" * 90, "▁ literal", "\x00", "ünïcödé ÄÖ"]
    for size in (1 << 20, 5):
        monkeypatch.setattr(pieces, "SLICE", size)
        for text, ids in zip(texts, pieces.encoder(model)(pa.array([t.encode() for t in texts]))):
            assert pieces.decode_ids(model, ids.astype(np.int64)).decode() == text
            byte = np.isin(ids, model.byte_id)
            lost = sum(1 for c in text if c not in keys)
            score = model.score[ids[~byte]].sum() + lost * model.unknown
            assert score == pytest.approx(best_score(model, keys, (" " + text).replace("▁", "")))


def test_classifier(docs, none, labels, clashing):
    got = neighbours.score_documents(docs, labels)
    assert got.count() == len(rows())
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert neighbours.score_documents(none, labels).count() == 0
    assert {r.score for r in neighbours.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    same(neighbours.score_documents(clashing, labels), got)


def test_search(spark):
    vectors = [(0, [1.0, 0.5]), (50, [0.0, -1.0]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [None, 1.0]),
               (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]), (None, [1.0, 1.0]), (7, []), (8, [2.0]), (0, [1.0, 0.5])]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in vectors],
                                  "vec_id BIGINT, embedding ARRAY<FLOAT>, score INT, rank INT")
    got = [tuple(r) for r in topk.top_k(table, block=2, segment_blocks=1, group=1).orderBy("query_id", "rank").collect()]
    # The id 0 has two rows: each is a query and a candidate of the other.
    assert got == [r for r in [(0, 1, 8, 131072), (0, 2, 0, 81920), (0, 3, 1, 81920), (0, 4, 2, 81920), (0, 5, 7, 0)]
                   for _ in range(2)] + [(50, 1, 7, 0), (50, 2, 8, 0), (50, 3, 0, -32768), (50, 4, 0, -32768),
                                         (50, 5, 1, -32768)]
    assert topk.top_k(table.limit(0)).count() == 0


@pytest.mark.parametrize("skewed", [False, True])
def test_search_prunes_exactly(skewed):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-9, 9, (400, 6))
    if skewed:  # most blocks hold short vectors only
        vectors[40:] //= 8
    ids = np.arange(400)
    blocks = [(ids[a:a + 16], ids[a:a + 16], vectors[a:a + 16]) for a in range(0, 400, 16)]
    row, near, score, made = topk.search(ids[::50], vectors[::50], np.full(8, topk.LOWEST), blocks, 5)
    for q in range(8):
        all_scores = sorted((-int(vectors[q * 50] @ vectors[j]), j) for j in range(400) if j != q * 50)[:5]
        assert [(-s, j) for s, j in all_scores] == [(s, j) for s, j in zip(score[row == q], near[row == q])]
    assert made < 0.4 * 8 * 400 if skewed else made <= 8 * 400


def test_search_sends_only_reached_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(600, 4)).round(3)
    vectors[::50] += 1.0
    vectors[200:] /= 50
    ids = [i - i % 7 if i > 500 else i for i in range(600)]  # some rows share an id
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    sent, plain = [], topk.reached
    monkeypatch.setattr(topk, "reached", lambda *a: sent.append((plain(*a), a[1])) or sent[0][0])
    got = sorted(tuple(r) for r in topk.top_k(table, block=16, segment_blocks=2, group=4).collect())
    whole = np.floor(256 * vectors).astype(np.int64)
    want = []
    for q in range(600):
        if ids[q] % 50 == 0:
            scores = sorted((-int(whole[q] @ whole[j]), ids[j]) for j in range(600) if j != q)[:5]
            want += [(ids[q], r, j, -s) for r, (s, j) in enumerate(scores, 1)]
    assert got == sorted(want)
    kept, cells = sent[0]  # of all (group, block) cells but those of the first pass
    assert 0 < kept.count() < cells.count()


def test_search_equals_its_sql_on_repeated_ids(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=3).round(2).tolist()) for i in [0, 0, 1, 1, 1, 2, 50, 50, 51, 99, 100, 100]]
    rows += [(3, None), (0, [None, 1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    table.coalesce(1).write.parquet(f"{tmp_path}/e")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/e/*.parquet')")
    want = sorted(con.execute(topk.OP3_SQL).fetchall())
    assert sorted(tuple(r) for r in topk.top_k(table).collect()) == want and len(want) == 6 * 5


def test_large_products_are_exact():
    big = np.array([[1 << 40, -(1 << 40)]])
    assert topk.products(big, np.array([[1 << 20, 1]])).tolist() == [[(1 << 60) - (1 << 40)]]
    assert topk.products(big, big).tolist() == [[topk.HIGHEST]]


def test_paragraphs(docs, none, clashing, spark):
    got = paragraphs.repeated_paragraphs(docs)
    found = sorted((r.doc_id, r.class_doc_id, r.removed) for r in got.collect())
    assert found == [(1, 1, False), (1, 1, False), (2, 1, True), (3, 1, True)]
    assert paragraphs.repeated_paragraphs(none).count() == 0
    same(paragraphs.repeated_paragraphs(clashing), got)


CONV = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, position INT, target INT"


def test_quotes(spark):
    said = [(1, 0, "user", "How do I sort a list?\n\nAlso: is it stable?"),
            (1, 1, "assistant", "Use sorted.\n> How do I sort a list?\nThat is all."),
            (1, 2, "user", "thanks"),
            (1, 3, "user", "On Monday someone wrote:\n>> how do I  SORT a list\n> Use sorted.\n> That is all.\n\nOr sort()."),
            (1, 4, "user", "> never said"), (2, 0, "user", None), (2, 1, "user", "> How do I sort a list?"),
            (None, 0, "user", "x"), (3, None, "user", "y"), (1, 2, "user", "thanks")]
    table = spark.createDataFrame([r + (1, 2) for r in said], CONV)
    got = {(r.conv_id, r.turn): r for r in quotes.reply_order(table).collect()}
    assert quotes.reply_order(table).count() == len(said)
    assert [got[1, t].position for t in range(5)] == [0, 1, 2, 3, 4]
    assert [got[1, t].parent_turn for t in range(5)] == [None, 0, 1, 1, 3]
    assert [got[1, t].branch for t in range(5)] == [0, 0, 0, 3, 3]
    assert got[1, 1].by_quote and got[1, 3].by_quote and not got[1, 4].by_quote
    assert got[1, 3].text == "Or sort()." and got[1, 4].text == "" and got[1, 1].text == "Use sorted.\nThat is all."
    assert got[1, 3].n_links == 2
    assert got[2, 1].parent_turn == 0 and not got[2, 1].by_quote
    assert got[None, 0].position is None and got[3, None].text == "y"
    assert quotes.reply_order(table.limit(0)).count() == 0


def test_quotes_over_blocks_of_turns(spark, monkeypatch):
    monkeypatch.setattr(quotes, "BLOCK_TURNS", 3)
    said = [(1, t, "user", f"message number {t % 4}" if t < 15 else f"> message number {t % 4}\nyes") for t in range(20)]
    got = {r.turn: r for r in quotes.reply_order(spark.createDataFrame([r + (1, 2) for r in said], CONV)).collect()}
    places, stack = {}, [0]
    while stack:  # a message, then its answers by turn
        t = stack.pop()
        places[t] = len(places)
        stack += sorted((u for u in got if got[u].parent_turn == t), reverse=True)
    for t in range(20):
        assert got[t].position == places[t]
        latest = max((u for u in range(15) if u % 4 == t % 4), default=None)
        assert got[t].parent_turn == (latest if t >= 15 else t - 1 if t else None)


def test_sha_of_no_spans(docs):
    cols = secrets.digest()
    got = secrets.find_secrets(docs).select("doc_id", cols["base_sha256"].alias("s")).collect()
    assert {r.s for r in got if r.doc_id == 1} == {hashlib.sha256(b"").hexdigest()}


def test_mixing_many_sources_and_words(spark):
    # 200,000 sources, one of them with 10**14 words: no product may pass 64 bits.
    sized = spark.range(200_000).select(F.format_string("s%06d", "id").alias("source"),
                                        F.when(F.col("id") == 7, 10**14).otherwise(F.col("id") % 50).alias("size"))
    rows = {r.source: r for r in mixing.source_targets(sized).collect()}
    assert len(rows) == 200_000
    total = sum(r.source_size for r in rows.values())
    assert abs(sum(r.target for r in rows.values()) - total) < 1e-6 * total
    assert all(r.target <= 3 * r.source_size + 1e-6 for r in rows.values())


def test_mixing_without_ids_comes_near_the_target(spark):
    docs = spark.createDataFrame([(None, f"{i} w w w", s) for i in range(4000) for s in "ab"],
                                 "doc_id BIGINT, text STRING, source STRING")
    rows = mixing.with_copies(docs).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"),
                                                          F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 0.1 * r.target for r in rows)
