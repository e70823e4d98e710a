"""The registered queries on whole tables: against SQL, brute force or held-out labels."""

import hashlib
import importlib.util
import os
import re
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from actiflow.llm import queries, simhash
from conftest import ROOT, SF_SMALL

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def run(spark, name, sf=SF_SMALL):
    return queries.QUERIES[name](spark, sf).collect()


def classes(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_sql(spark):
    spec = importlib.util.spec_from_file_location("check_oracle", os.path.join(ROOT, "scripts", "check_oracle.py"))
    checker = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(checker)
    result = checker.compare(spark, SF_SMALL, set(queries.ORACLES), verbose=True)
    assert result and set(result.values()) == {"OK"}, result


def test_op1_round_trips(spark, documents):
    pytest.importorskip("sentencepiece")
    rows = run(spark, "op1_sentencepiece")
    assert len(rows) == len(documents) and all(r.round_trip for r in rows)


def test_op2_without_quotes_keeps_turns(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    rows = {(r.conv_id, r.turn): r for r in run(spark, "op2_quotes")}
    assert len(rows) == len(table)
    by_conv = defaultdict(list)
    for r in table:
        by_conv[r.conv_id].append(r.turn)
    for r in table:
        turns = sorted(by_conv[r.conv_id])
        at = turns.index(r.turn)
        got = rows[r.conv_id, r.turn]
        assert (got.position, got.parent_turn) == (at, turns[at - 1] if at else None)
        assert got.text == r.text.strip()


def test_op4_held_out_accuracy(spark):
    rows = run(spark, "op4_neighbours", SF)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    seen = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y, _ in seen if y], [s for s, y, _ in seen if not y]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.95 and np.mean([p == y for _, y, p in seen]) > 0.95


def test_op5_brute_force(spark, documents):
    texts = defaultdict(list)
    for r in documents.values():
        at = 0
        for n, line in enumerate(r.text.split("\n")):
            words = tuple(line.encode().lower().split())
            if len(words) >= 20:
                texts[words].append((r.doc_id, n, at, at + len(line)))
            at += len(line) + 1
    distinct = list(texts)
    sets = [set(zip(*(w[i:] for i in range(5)))) for w in distinct]
    links = [(a, b) for a, b in combinations(range(len(sets)), 2)
             if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    groups = defaultdict(list)
    for i, root in enumerate(classes(len(distinct), links)):
        groups[root] += texts[distinct[i]]
    want = {}
    for group in groups.values():
        if len(group) > 1:
            first = min(group)
            want |= {(d, n): (a, b, first[0], first[1], (d, n) != first[:2]) for d, n, a, b in group}
    got = {(r.doc_id, r.paragraph): (r.start, r.end, r.class_doc_id, r.class_paragraph, r.removed)
           for r in run(spark, "op5_paragraphs") if not r.embedded}
    assert got == want and len(want) > 20


def test_op5_finds_shared_runs(spark, documents):
    texts = {i: (r.text or "").encode().lower().split() for i, r in documents.items()}
    holders = defaultdict(set)
    for i, words in texts.items():
        for at in range(len(words) - 50):
            holders[hash(tuple(words[at:at + 51]))].add(i)
    sharing = {i for x in holders.values() if len(x) > 1 for i in x}
    rows = run(spark, "op5_paragraphs")
    found = {r.doc_id for r in rows}
    assert len(sharing) > 20 and len(sharing & found) >= 0.95 * len(sharing)
    # What is found inside other lines is there, and somewhere else as well.
    units = defaultdict(list)
    for r in rows:
        if r.embedded:
            words = tuple(documents[r.doc_id].text[r.start:r.end].encode().lower().split())
            assert len(words) == r.n_words == 20
            units[words].append(r)
    everywhere = defaultdict(set)
    for i, words in texts.items():
        for at in range(len(words) - 19):
            if tuple(words[at:at + 20]) in units:
                everywhere[tuple(words[at:at + 20])].add((i, at))
    assert all(len(everywhere[w]) > 1 for w in units)


def test_op6_brute_force(spark, documents):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                        re.ASCII | re.IGNORECASE)
    for r in run(spark, "op6_secrets"):
        text = documents[r.doc_id].text
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]


def test_op7_brute_force(spark, documents):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers
    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, rows = 0, {r.doc_id: r for r in run(spark, "op7_token_files")}
    for i in sorted(documents):
        ids = np.array(plain.encode(documents[i].text, add_special_tokens=False).ids + [2], "<u4")
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op8_brute_force(spark, documents):
    ids = sorted(documents)
    prints = [plain_fingerprint(documents[i].text) for i in ids]
    links = [(a, b) for a, b in combinations(range(len(ids)), 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = {(ids[i], f"{prints[i]:016x}", ids[r]) for i, r in enumerate(classes(len(ids), links))}
    assert {tuple(r)[:3] for r in run(spark, "op8_simhash")} == want
    assert len({w[2] for w in want}) < len(want)


def test_fingerprint_links_in_chunks(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = [base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for _ in range(6)]
    noise = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    far = base[:20] ^ np.uint64(0b11111)  # five bits: not linked to the base itself
    values = sorted({int(x) for x in np.concatenate([*flips, noise, far, [0, 0b1111, 0b11111111]])})
    links = [(a, b) for a, b in combinations(range(len(values)), 2) if (values[a] ^ values[b]).bit_count() <= 4]
    want = classes(len(values), links)
    table = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp BIGINT")
    at = {simhash.signed(v): i for i, v in enumerate(values)}
    for chunk in (3, 2048):
        found = [(at[r.a], at[r.b]) for r in simhash.fingerprint_links(table, chunk=chunk).collect()]
        assert all((values[a] ^ values[b]).bit_count() <= 4 for a, b in found)
        assert classes(len(values), found) == want


def test_components_of_chains_and_stars(spark):
    from actiflow.llm.components import connected_components
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(205, 203), (203, 209), (7, 7)]
    rows = connected_components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {203: 203, 205: 203, 209: 203}
    assert len(rows) == len(want) and {r.node: r.root for r in rows} == want
    assert connected_components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def test_op9_near_targets(spark):
    rows = run(spark, "op9_mixing", "/root/testdata/sf0.1")
    taken, target, size = defaultdict(int), {}, 0
    for r in rows:
        taken[r.source_size, r.target] += r.taken
        target[r.source_size, r.target] = r.target
        size += r.size
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    assert sum(target.values()) == pytest.approx(size)
    assert all(abs(taken[k] - t) <= 0.15 * t for k, t in target.items())


def test_pipeline(spark):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline
    from actiflow.llm import mixing, pieces, quality_rules, secrets
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "secret_scans", "mixing", "sentencepiece"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == docs.columns + ["piece_ids"]
    # The same by plain Python.
    kept = {r.doc_id for r in quality_rules.judge(docs).collect() if r.kept}
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id in kept}
    ids = sorted(rows)
    prints = [plain_fingerprint(rows[i].text) for i in ids]
    links = [(a, b) for a, b in combinations(range(len(ids)), 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    firsts = [ids[i] for i, r in enumerate(classes(len(ids), links)) if i == r]
    keywords = secrets.automaton()
    texts = {i: secrets.redacted(rows[i].text.encode(), secrets.scan(rows[i].text.encode(), keywords)) for i in firsts}
    clean = spark.createDataFrame([(i, texts[i], rows[i].source) for i in firsts], "doc_id BIGINT, text STRING, source STRING")
    copies = {r.doc_id: r.copies for r in mixing.with_copies(clean).collect()}
    found = defaultdict(int)
    for r in got.collect():
        found[r.doc_id] += 1
        assert r.text == texts[r.doc_id] and r.n_chars == len(r.text)
    assert dict(found) == {i: n for i, n in copies.items() if n}
    import public_tokenizers
    back = pieces.decode(got, public_tokenizers.path("piece_bpe_32k.model"))
    assert back.filter("decoded <> text").count() == 0
