"""Stages of the pipeline, mixtures and fingerprints against plain versions of their own."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import prose, words_of
from test_near_duplicates import brute as classes_of

import corpus_pipeline
from larkspur.llm import fingerprints, mixing
from larkspur.llm.anchors import Hasher

COLUMNS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, extra INT"
STAGES = dict(corpus_pipeline.STAGES)
TOKEN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Near copies, shared passages, benchmark passages, a hot source, NULL and empty texts, and an extra column."""
    rng = random.Random(11)
    passage, base = prose(rng, 60), prose(rng, 150).split()
    items = [(f"i{k}", prose(rng, 25)) for k in range(4)] + [("short", "only three words"), ("none", None)]
    texts = [prose(rng, rng.randrange(20, 150)) for _ in range(30)]
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 25)} Äö" for _ in range(6)]
    texts += [" ".join(base[:i] + [f"x{i}"] + base[i + 1:]) for i in range(0, 60, 10)] + [texts[2]] * 3
    texts += [f"{prose(rng, 80)} {items[k][1].upper()}, {prose(rng, 80)}" for k in range(4)]
    texts += [items[0][1] + " " + prose(rng, 5), f"{prose(rng, 40)} Only, three WORDS {prose(rng, 40)}", "", None, " \n"]
    rows = [(i, t, "en", ["a", "b", None, "Z"][min(i % 9, 3)], len(t or ""), i) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame(items, "item_id STRING, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    return spark.createDataFrame(rows, COLUMNS).repartition(4).cache(), dict(items), folder


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_near_copies_stage(spark, planted):
    docs, _, folder = planted
    kept = STAGES["n-gram jaccard join"](spark, docs, folder)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    least = {c for _, c, _, _ in classes_of(rows)}
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in docs.collect() if r["doc_id"] in least)


def test_repeated_strings_stage(spark, planted):
    docs, _, folder = planted
    rows = {i: (r["text"] or "").encode() for i, r in by_id(docs).items()}
    seen = Counter(t[i:i + 200] for t in rows.values() for i in range(len(t) - 199))
    got = by_id(STAGES["suffix-array dedup"](spark, docs, folder))
    assert set(got) == set(rows)
    changed = 0
    for i, data in rows.items():
        gone = np.zeros(len(data), dtype=bool)
        for at in range(len(data) - 199):
            if seen[data[at:at + 200]] > 1:
                gone[at:at + 200] = True
        left = bytes(np.frombuffer(data, dtype=np.uint8)[~gone]).decode("utf-8", "ignore")
        changed += gone.any()
        assert got[i]["text"] == left and got[i]["n_chars"] == len(left) and got[i]["extra"] == i
    assert changed > 8


def test_benchmark_stage(spark, planted):
    docs, items, folder = planted
    windows = set()
    for text in items.values():
        words = TOKEN.findall((text or "").encode().lower())
        size = min(10, len(words))
        windows |= {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()
    got, removed = by_id(STAGES["benchmark decontamination"](spark, docs, folder)), 0
    for i, row in by_id(docs).items():
        data = (row["text"] or "").encode()
        found = [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(data.lower())]
        hit = np.zeros(len(found), dtype=bool)
        for size in {len(w) for w in windows}:
            for at in range(len(found) - size + 1):
                if tuple(w for _, _, w in found[at:at + size]) in windows:
                    hit[at:at + size] = True
        if hit.sum() * 2 > len(found):
            assert i not in got
            removed += 1
            continue
        mask, place = np.ones(len(data), dtype=bool), 0
        while place < len(found):
            end = place
            while end < len(found) and hit[end]:
                end += 1
            if end > place:
                mask[found[place][0]:found[end - 1][1]] = False
            place = max(end, place + 1)
        want = bytes(np.frombuffer(data, dtype=np.uint8)[mask]).decode()
        assert (got[i]["text"] or "") == want and (got[i]["n_chars"] or 0) == len(want)
        removed += not mask.all()
    assert removed >= 6 and len(got) < docs.count()


def filled(sizes, weights):
    """Targets by bisection on the unit of weight: their sum is all words, none above thrice its source."""
    low, high = 0.0, 4.0 * sum(sizes) + 1
    for _ in range(300):
        unit = (low + high) / 2
        low, high = (unit, high) if sum(min(w * unit, 3 * s) for s, w in zip(sizes, weights)) < sum(sizes) else (low, unit)
    return [min(w * high, 3 * s) for s, w in zip(sizes, weights)]


@pytest.mark.parametrize("sizes", [[10, 1000, 1000], [0, 50], [5, 70, 900, 3], [7], [0, 0, 9], [3, 3, 3, 3, 3000, 1]])
def test_targets_against_bisection(sizes):
    weights = [1 + i % 3 for i in range(len(sizes))]
    assert mixing.targets(sizes, weights) == pytest.approx(filled(sizes, weights), abs=1e-6)


def test_mixture_stage(spark, planted):
    docs, _, folder = planted
    rows = by_id(docs)
    totals = Counter()
    for r in rows.values():
        totals[r["source"]] += len(words_of(r["text"]))
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(order, filled([totals[s] for s in order], [1 + i % 3 for i in range(len(order))])))
    taken, per_doc = Counter(), Counter()
    for r in STAGES["mixing sources"](spark, docs, folder).collect():
        words = words_of(rows[r["doc_id"]]["text"])
        assert words_of(r["text"]) == words[:r["mix_words"]] and r["n_chars"] == len(r["text"]) and r["source"] == rows[r["doc_id"]]["source"]
        taken[r["source"]] += r["mix_words"]
        per_doc[r["doc_id"]] += r["mix_words"]
    assert all(abs(taken[s] - wanted[s]) <= 1 for s in order)
    assert all(n <= 3 * len(words_of(rows[d]["text"])) for d, n in per_doc.items())


def plain_digest(data, ranks):
    """Filters of a text as sets of bits, by the definition, window by window."""
    width, near = fingerprints.WIDTH, fingerprints.NEAR
    terms = [0] + [round(c * math.log2(c) * (1 << 20)) for c in range(1, width + 1)]
    most = 6 * width << 20
    rank = []
    for i in range(len(data) - width + 1):
        total = sum(terms[c] for c in Counter(data[i:i + width]).values())
        rank.append(int(ranks[(most - total) * 1000 // most]))
    chosen = Counter()
    for start in range(1 - near, len(rank)):
        best = min(((rank[p], p) for p in range(max(0, start), min(len(rank), start + near))), default=(fingerprints.BINS, 0))
        if best[0] < fingerprints.BINS:
            chosen[best[1]] += 1
    places = sorted(p for p, n in chosen.items() if n >= fingerprints.POPULAR)
    features = [data[p:p + width] for p in places] or ([data] if data else [])
    filters = []
    for k, feature in enumerate(features):
        if k % fingerprints.FULL == 0:
            filters.append([set(), 0])
        buffer = np.frombuffer(feature, dtype=np.uint8)
        hashed = int(Hasher(buffer, 0)(np.array([0]), np.array([len(feature)]))[0])
        filters[-1][0].update((hashed >> (11 * p)) & 2047 for p in range(fingerprints.PROBES))
        filters[-1][1] += 1
    return filters


def plain_likeness(one, two):
    one, two = [f for f, _ in one], [f for f, _ in two]
    if one == two:
        return 1.0
    one, two = (one, two) if len(one) <= len(two) else (two, one)
    if not one:
        return 0.0

    def score(a, b):
        least, chance = min(len(a), len(b)), len(a) * len(b) / 2048
        nothing = chance + 0.15 * (least - chance)
        return min(1.0, max(0.0, (len(a & b) - nothing) / max(least - nothing, 1e-9)))

    rows = [max(score(a, b) for b in two) for a in one]
    if len(one) < len(two):
        return sum(rows) / len(rows)
    columns = [max(score(a, b) for a in one) for b in two]
    return max(sum(rows), sum(columns)) / len(rows)


def test_fingerprints_by_definition(spark, corpus):
    rows = sorted((i, (t or "")[:2500]) for i, t in corpus if i % 3 == 0 or i > 70)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    counts = fingerprints.count_entropies(docs)
    width = fingerprints.WIDTH
    assert counts.sum() == sum(max(0, len(t.encode()) - width + 1) for _, t in rows)
    ranks = fingerprints.rarity(counts)
    got = {r["doc_id"]: r for r in fingerprints.compare_with_next(docs).collect()}
    prints = {i: plain_digest(t.encode(), ranks) for i, t in rows}
    for k, (i, text) in enumerate(rows):
        after_id, after = rows[(k + 1) % len(rows)]
        half = len(text) // 2
        edited = plain_digest((text[:len(text) - half] + after[:half]).encode(), ranks)
        for name, want in (("fingerprint", prints[i]), ("edited_fingerprint", edited)):
            bits, features = fingerprints.from_string(got[i][name])
            found = [set(np.flatnonzero(np.unpackbits(row.view(np.uint8))).tolist()) for row in bits]
            assert found == [f for f, _ in want] and features.tolist() == [n for _, n in want]
        assert got[i]["near_edited"] == pytest.approx(plain_likeness(prints[i], edited), abs=1e-12)
        assert got[i]["near_next"] == pytest.approx(plain_likeness(prints[i], prints[after_id]), abs=1e-12)


def test_quality_scores_of_a_whole_table(spark, folder):
    """Every row's score is the rules' weighted sum, worked out from its statistics in Python."""
    from larkspur.llm import quality

    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = quality.with_statistics(docs).withColumn("score", model.score()).collect()
    assert len(rows) == docs.count() and model.rules
    for row in rows:
        total = model.intercept + sum(
            w for rule, w in zip(model.rules, model.weights) if all((row[s] > t) == above for s, above, t in rule.tests))
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)
