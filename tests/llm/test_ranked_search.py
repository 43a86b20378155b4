"""Ranked search against scores of all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from larkspur.llm import ranked_search
from larkspur.llm.ranked_search import Best, Tree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def brute_force(rows, items, k=10):
    """``(item_id, rank, doc_id, score)`` by the definition, plainly."""
    docs = [(d, Counter(terms_of(t))) for d, t in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    found = []
    for item_id, text in items:
        asked = terms_of(text)
        scored = []
        for doc_id, counts, n in docs:
            m = 25 + 75 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * counts[t] // (1000 * counts[t] + 8 * m))
                        for t in asked if t in counts)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item_id, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return found


@pytest.fixture(scope="module")
def items(corpus):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices((corpus[i][1] or "x").split() or ["x"], k=8))) for i in range(40)]
    return rows + [(100, None), (101, ""), (102, "unheard-of"), (103, "W1 w1 w1 W2"), (103, "W1 w1 w1 W2"), (None, "new3, Same"),
                   (104, "ÜNÏCODE ß　text"), (105, "one two")]


def as_bag(rows):
    return sorted(map(repr, (tuple(r) for r in rows)))


@pytest.mark.parametrize("kind", ["docs", "odd_docs"])
@pytest.mark.parametrize("per_block", [2000, 7])
def test_lists_equal_the_scores_of_all_pairs(spark, request, items, kind, per_block):
    docs = request.getfixturevalue(kind)
    asked = spark.createDataFrame([(i, t, -1) for i, t in items], "item_id BIGINT, text STRING, score INT")
    want = brute_force([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert as_bag(ranked_search.rank_documents(docs, asked, items_per_block=per_block).collect()) == as_bag(want)


def test_text_ids_and_empty_tables(spark, docs, no_docs, items):
    from pyspark.sql import functions as F

    asked = spark.createDataFrame([(f"i{i}", t) for i, t in items], "item_id STRING, text STRING")
    named = docs.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text")
    want = brute_force([(r["doc_id"], r["text"]) for r in named.collect()], [(f"i{i}", t) for i, t in items], 3)
    got = ranked_search.rank_documents(named, asked, k=3).collect()
    # Text ids of the brute force are compared as text, too.
    assert as_bag(got) == as_bag(want)
    assert ranked_search.rank_documents(no_docs, asked).count() == 0
    assert ranked_search.rank_documents(docs, asked.limit(0)).count() == 0


def small_tree(seed, n_docs=3000, n_terms=60, copies=0):
    """Documents about topics: some of 12 common terms, most of a topic's six."""
    rng = np.random.default_rng(seed)
    topics = [rng.choice(np.arange(12, n_terms), 6, replace=False) for _ in range(40)]
    vectors, tfs = [], []
    for _ in range(n_docs):
        own = topics[rng.integers(40)]
        own = np.sort(np.concatenate((np.flatnonzero(rng.random(12) < 0.4), own[rng.random(6) < 0.8]))).astype(np.int64)
        vectors.append(own)
        tfs.append(rng.geometric(0.5, len(own)))
    vectors[:copies], tfs[:copies] = [vectors[0]] * copies, [tfs[0]] * copies
    ids = rng.permutation(n_docs).tolist()
    m = rng.integers(25, 400, n_docs)
    m[:copies] = m[0]
    return ids, m, vectors, tfs


@pytest.mark.parametrize("seed, copies", [(0, 0), (1, 0), (2, 1500)])
def test_branch_and_bound_leaves_documents_out_but_no_result(seed, copies, monkeypatch):
    monkeypatch.setattr(ranked_search, "LEAF", 8)
    ids, m, vectors, tfs = small_tree(seed, copies=copies)
    df = np.bincount(np.concatenate(vectors), minlength=60)
    tree = Tree(ids, m, vectors, tfs, 60)
    rng = np.random.default_rng(seed)
    by_term, visited = np.zeros(60, dtype=np.int64), 0
    for _ in range(20):
        wanted = rng.permutation(vectors[rng.integers(len(vectors))])
        weights = np.array([ranked_search.weight(len(ids), int(df[t])) for t in wanted], dtype=np.int64)
        best = Best(10)
        visited += tree.search(wanted, weights, by_term, best)
        assert not by_term.any()
        own = dict(zip(wanted.tolist(), weights.tolist()))
        scores = sorted((-sum(own[t] * (10 ** 9 * int(f) // (1000 * int(f) + 8 * int(norm))) for t, f in zip(v.tolist(), tf) if t in own), i)
                        for i, norm, v, tf in zip(ids, m, vectors, tfs))
        assert best.rows() == [(-s, i) for s, i in scores[:10] if s < 0]
    assert visited < 20 * len(ids) * 0.6


def test_nodes_hold_the_maxima_and_minima_below_them():
    ids, m, vectors, tfs = small_tree(5, n_docs=1000, copies=200)
    tree = Tree(ids, m, vectors, tfs, 60)
    stored = dict(zip(tree.keys.tolist(), tree.most.tolist()))
    assert (np.diff(tree.keys) > 0).all()
    for node in range(len(tree.low)):
        low, high = tree.low[node], tree.high[node]
        assert tree.least_m[node] == tree.m[low:high].min()
        span = slice(tree.first[low], tree.first[high])
        for term in set(tree.term[span].tolist()):
            assert stored[node * 60 + term] == tree.tf[span][tree.term[span] == term].max()
        if tree.child[node]:
            assert [tree.low[c] for c in range(tree.child[node], tree.last[node])][0] == low
            assert tree.high[tree.last[node] - 1] == high
        else:
            assert high - low <= ranked_search.LEAF
