"""The Jaccard join against all pairs, and the component search."""

import random
from collections import Counter

import pytest
from conftest import words_of

from larkspur.llm import near_duplicates
from larkspur.llm.components import components


def brute(rows, threshold=0.8, size=5):
    texts = sorted({t or "" for _, t in rows})
    sets = []
    for text in texts:
        words = words_of(text)
        sets.append({tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    links, parent = Counter(), list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    place = {t: i for i, t in enumerate(texts)}
    least = {}
    for doc, text in rows:
        root = find(place[text or ""])
        if doc is not None:
            least[root] = min(doc, least.get(root, doc))
    copies = Counter(t or "" for _, t in rows)
    return Counter((d, least.get(find(place[t or ""])), links[place[t or ""]], copies[t or ""] - 1) for d, t in rows)


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
@pytest.mark.parametrize("block", [512, 4])
def test_against_all_pairs(request, which, block):
    """A block of 4 cuts the group of near copies into many pairs of blocks."""
    frame = request.getfixturevalue(which)
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    got = near_duplicates.similar_classes(frame, block=block).select("doc_id", "class_id", "n_links", "n_copies").collect()
    assert Counter(map(tuple, got)) == brute(rows)


def test_one_of_each_class_stays(docs, odd_docs, corpus):
    kept = near_duplicates.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    classes = {d: c for d, c, _, _ in brute(corpus)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(classes.values()))
    rows = [(r["doc_id"], r["text"]) for r in near_duplicates.keep_one_of_each(odd_docs).collect()]
    assert len(rows) == len(set(rows)) and len({t or "" for _, t in rows}) == len(rows)
    assert sum(not (t or "").strip() for _, t in rows) == 1


def test_empty_table(no_docs):
    assert near_duplicates.similar_classes(no_docs).count() == 0
    assert near_duplicates.keep_one_of_each(no_docs).count() == 0


def test_shortening_ends_where_the_recall_is_reached():
    depth = near_duplicates.prefix_depth(0.8, 30, 12, 0.999)
    assert near_duplicates.found_with(0.8, 30, depth) >= 0.999 > near_duplicates.found_with(0.8, 30, depth + 1)
    with pytest.raises(ValueError):
        near_duplicates.prefix_depth(0.1, 2, 12, 0.999)


def random_signatures(rng, n, labels=6):
    """Rows ``(node, signature)``: two trees, few labels, one signature that a third of the nodes share."""
    rows = []
    for i in range(n):
        for tree in range(2):
            body = [3] * labels if i % 3 == 0 else [rng.randrange(3) for _ in range(labels)]
            rows.append((i.to_bytes(4, "big"), bytes([0, tree, *body])))
    return rows


@pytest.mark.parametrize("partitions", [1, 13])
def test_forest_joins_what_shares_a_prefix(spark, partitions):
    rows = random_signatures(random.Random(5), 120)
    groups = {}
    for node, signature in rows:
        groups.setdefault(signature[:2 + 4], []).append(node)
    edges = [(own[0], other) for own in groups.values() for other in own[1:]]
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(partitions)}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        frame = spark.createDataFrame(rows, "node BINARY, signature BINARY")
        found = near_duplicates.forest_links(frame, max_depth=6, depth=4).collect()
        wanted = components(spark.createDataFrame(edges, "u BINARY, v BINARY")).collect()
        got = components(spark.createDataFrame([tuple(map(bytes, r)) for r in found], "u BINARY, v BINARY")).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    # Every link lies inside a node of a trie, and together they join all of it.
    members = [set(own) for own in groups.values()]
    assert all(any({bytes(r["u"]), bytes(r["v"])} <= own for own in members) for r in found)
    assert {(bytes(r["node"]), bytes(r["root"])) for r in got} == {(bytes(r["node"]), bytes(r["root"])) for r in wanted}


def test_deep_groups_are_not_grouped_again():
    """A level links heads of deeper groups only: a trie node of n rows costs n - 1 links over all levels."""
    import pyarrow as pa

    rows = sorted(random_signatures(random.Random(6), 200), key=lambda r: (r[1], r[0]))
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*rows[i:i + 37])], names=["node", "signature"])
               for i in range(0, len(rows), 37)]
    out = [r for b in near_duplicates._trie_links(8, 4)(iter(batches)) for r in b.to_pylist()]
    links = [(r["u"], r["v"]) for r in out if r["v"] is not None]
    assert len(links) == len(rows) - len({s[:6] for _, s in rows})
    assert [r["signature"] for r in out if r["v"] is None] == [rows[0][1], rows[-1][1]]
    # Nobody but a head is linked at a level above its own.
    deep = {}
    for node, signature in rows:
        deep.setdefault(signature, node)
    whole = sum(1 for i, (_, s) in enumerate(rows) if i and s == rows[i - 1][1])
    assert whole == len(rows) - len(deep) and whole > len(rows) / 3


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {(r["node"], r["root"]) for r in components(spark.createDataFrame(edges, "u BIGINT, v BIGINT")).collect()}
    assert got == {(x, find(x)) for x in list(parent)}
    assert components(spark.createDataFrame([], "u BIGINT, v BIGINT")).count() == 0
