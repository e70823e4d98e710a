"""FP-tree search: against plain scoring; pruning; small cases."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from actiflow.llm import fp_search, queries
from conftest import SF_SMALL

DOCS = "doc_id BIGINT, text STRING"
ITEMS = "item_id BIGINT, text STRING"


def plain_terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def plain(docs, items, k=10):
    bags = [(i, plain_terms(t)) for i, t in docs]
    bags = [(i, len(x), Counter(x)) for i, x in bags if x]
    n_docs, length = len(bags), sum(n for _, n, _ in bags)
    df = Counter(t for _, _, c in bags for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, n, c in bags:
            m = 100 - 75 + 75 * n * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in plain_terms(text) if c[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        out += [(item, r, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(queries.QUERIES["op13_lexical_search"](spark, SF_SMALL)) == plain(docs, items)


def corpus():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "x9", "日本"]
    p = 1 / np.arange(1, len(words) + 1)
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 60), p=p / p.sum()))) for i in range(400)]
    docs += [(None, docs[5][1]), (None, None), (7, docs[7][1]), (7, "w1 W1, w1!"), (900, ""), (901, " -- "),
             (902, "w0 " * 30000 + "rare"), (903, docs[5][1]), (904, docs[5][1])]
    items = [(i, " ".join(rng.choice(words, 6))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "unheard of"), (None, "w3 w3 w4"), (53, "w3 w3 w4"), (53, "rare"), (54, "日本 ünï Ünï"),
              (55, docs[5][1])]
    return docs, items


@pytest.mark.parametrize("group_bytes", [1 << 20, 40])
def test_brute_force(spark, group_bytes, monkeypatch):
    docs, items = corpus()
    result = fp_search.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS),
                              group_bytes=group_bytes)
    assert got(result) == plain(docs, items)


def test_item_sets_hold_all_items():
    items = [[(t, 1) for t in range(i, i + 5)] for i in range(20)]
    sets = fp_search.item_sets(items, most=8)
    assert sorted(i for s in sets for i in s) == list(range(20)) and len(sets) > 1
    assert all(len({t for i in s for t, _ in items[i]}) <= 8 for s in sets)
    assert fp_search.item_sets([[(t, 1) for t in range(50)]], most=8) == [[0]]


def test_tree_prunes_and_keeps_ties():
    rng = np.random.default_rng(0)
    freq = (rng.random((2000, 40)) < 1 / np.arange(1, 41)).astype(np.int32)
    freq[:30, 20:26] = 3  # few documents hold the item's terms
    m = np.full(2000, 100, np.int64)
    tree = fp_search.Tree(freq, m)
    cols, weights = np.arange(20, 26), np.full(6, 5000, np.int64)
    best = []
    scored = tree.search(cols, weights, list(range(2000)), best, 10)
    plain_scores = fp_search.shares(freq[:, cols].astype(np.int64), m[:, None]) @ weights
    want = sorted((-int(s), False, i) for i, s in enumerate(plain_scores) if s)[:10]
    assert best == want and [x[2] for x in best] == list(range(10))
    assert scored < 1000  # of 2000


def test_tree_shares_paths():
    rows = np.zeros((64, 6), np.int32)
    rows[:, 0] = 1
    rows[32:, 1] = 1
    rows[:32, 2] = 1
    tree = fp_search.Tree(rows, np.arange(64) + 25, leaf=4)
    # The root is the common first term; two branches hold equal lists and are leaves.
    assert sorted(tree.bounds) == [(0, 32), (0, 64), (32, 64)]
    assert tree.least[0] == 25 and tree.top[0].tolist() == [1, 1, 1, 0, 0, 0]
    assert fp_search.Tree(np.zeros((0, 3), np.int32), np.zeros(0, np.int64)).search(
        np.arange(2), np.ones(2, np.int64), [], [], 3) == 0


def test_small_cases(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    one_doc, one_item = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(9, "b")], ITEMS)
    assert got(fp_search.search(docs, one_item)) == [] and got(fp_search.search(one_doc, items)) == []
    assert got(fp_search.search(docs, items)) == []
    clash = spark.createDataFrame([(1, "a b", 3, 4, "q")], DOCS + ", score INT, RANK INT, part STRING")
    other = spark.createDataFrame([(9, "b", 1, 2)], ITEMS + ", nr INT, doc INT")
    assert got(fp_search.search(clash, other)) == plain([(1, "a b")], [(9, "b")])
