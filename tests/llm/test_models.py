"""Quality rules, language-model scores, mixing, the pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import words_of
from pyspark.sql import functions as F

from larkspur.llm import lm_scores, mixing, quality
from larkspur.llm.elias_fano import BLOCK, EliasFano, Store


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (1, 2**63), (1000, 3), (5000, 2**40), (3 * BLOCK + 5, 2**62), (BLOCK, 100)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    store = Store()
    sequence = EliasFano(values, store)
    assert (sequence.values() == values).all()
    queries = np.sort(np.concatenate([values[::3], rng.integers(0, top, 500, dtype=np.uint64)]))
    place, equal = sequence.successors(queries)
    assert (place == np.searchsorted(values, queries)).all()
    assert (equal == np.isin(queries, values)).all()
    store.close()


def test_successors_are_searched_between_their_pointers(monkeypatch):
    from larkspur.llm import elias_fano

    monkeypatch.setattr(elias_fano, "BLOCK", 64)
    rng = np.random.default_rng(8)
    contexts = np.unique(rng.integers(0, 1 << 40, 300)).astype(np.uint64)
    pairs = sorted({(int(r), int(s)) for r, s in zip(rng.integers(0, 300, 3000) // 3 * 3 % len(contexts), rng.integers(0, 1 << 40, 3000) % 5000)})
    rank, successors = np.array([r for r, _ in pairs]), np.array([s for _, s in pairs], dtype=np.uint64)
    counts, c1 = rng.integers(1, 50, len(pairs)), np.full(len(contexts), 1000)
    store = elias_fano.Store()
    trie = lm_scores.Trie(contexts, c1, rank, successors, counts, 100.0, store)
    # All known pairs, unknown successors (beyond a range's end, too), contexts without any, and unknown contexts.
    asked = set(pairs) | {(r, s) for r in range(len(contexts)) for s in (0, 1, 4999, 5000, (1 << 40) - 1)}
    rows = sorted([(int(contexts[r]), s, r) for r, s in asked] + [(int(contexts[0]) + 1, 3, -1), ((1 << 40) + 5, 3, -1)])
    got = trie.look_up(np.array([c for c, _, _ in rows], dtype=np.uint64), np.array([s for _, s, _ in rows], dtype=np.uint64))
    want = {p: round(-math.log10(n / 1100) * lm_scores.STEP) for p, n in zip(pairs, counts)}
    assert got.tolist() == [want.get((r, s), lm_scores.NONE) for _, s, r in rows]
    assert trie.pointers.at(np.arange(len(contexts) + 1)).tolist() == np.searchsorted(rank, np.arange(len(contexts) + 1)).tolist()
    store.close()


@pytest.mark.parametrize("which, block_bytes, split", [("docs", 12 << 20, 1 << 20), ("docs", 2000, 1 << 20), ("odd_docs", 3000, 20)])
def test_scores_by_definition(request, monkeypatch, which, block_bytes, split):
    """Small blocks make many shards; a small split cuts the common contexts."""
    monkeypatch.setattr(lm_scores, "SPLIT", split)
    frame = request.getfixturevalue(which)
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    tokens = [(d, [*words_of(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]) for d, t in rows]
    single, pair, context = Counter(), Counter(), Counter()
    for d, ts in tokens:
        if not held[d]:
            single.update(ts)
            pair.update(zip(["<s>", *ts[:-1]], ts))
            context.update(["<s>", *ts[:-1]])
    n, v = sum(single.values()), len(single)
    want = Counter()
    for d, ts in tokens:
        base = sum(math.log10((single[t] + 1) / (n + v + 1)) for t in ts)
        score = sum(math.log10((pair[b] + 100 * (single[b[1]] + 1) / (n + v + 1)) / (context[b[0]] + 100)) for b in zip(["<s>", *ts[:-1]], ts))
        want[(d, held[d], len(ts), sum(t in single for t in ts), n, round(base, 6))] += 1
        want[(d, len(ts), round(score / len(ts), 2))] += 1
    got = Counter()
    train = ~lm_scores.held_out(F.col("doc_id"))
    for r in lm_scores.score_documents(frame, train, block_bytes=block_bytes).collect():
        got[(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))] += 1
        got[(r["doc_id"], r["n_tokens"], round(r["score"] / r["n_tokens"], 2))] += 1
    assert sum(got.values()) == sum(want.values())
    # Rounding of a mean at a boundary may differ by quantisation.
    assert sum((got - want).values()) <= 2


def test_scores_of_empty_tables(docs, no_docs):
    assert lm_scores.score_documents(no_docs, F.lit(True)).count() == 0
    rows = lm_scores.score_documents(docs, F.lit(False)).collect()
    assert len(rows) == docs.count() and all(r["train_tokens"] == 0 and r["base_score"] == 0 and r["held_out"] for r in rows)


def _labelled(spark, n=400):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        good = rng.random() < 0.7
        words = [rng.choice(["the", "of", "river", "stone", "and", "light"]) for _ in range(rng.randrange(5, 80))]
        rows.append((i, " ".join(words if good else [w.upper() + "!!" for w in words]), int(good)))
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, quality INT")
    return frame.drop("quality"), frame.drop("text")


def test_quality_on_held_out_rows(spark):
    docs, labels = _labelled(spark)
    scored = quality.score_documents(docs, labels)
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 40
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_rules_say_what_their_columns_do(spark):
    docs, labels = _labelled(spark, 200)
    model = quality.fit(docs, labels)
    assert model.rules and all(model.weights)
    measured = quality.with_statistics(docs)
    row = measured.withColumn("score", model.score()).first()
    total = model.intercept + sum(
        w for rule, w in zip(model.rules, model.weights) if all((row[s] > t) == above for s, above, t in rule.tests))
    assert abs(row["score"] - 1 / (1 + math.exp(-total))) < 1e-9


def test_quality_of_odd_tables(spark, odd_docs, docs, no_docs):
    _, labels = _labelled(spark, 60)
    out = quality.score_documents(odd_docs, labels)
    assert out.count() == odd_docs.count() and len({c.lower() for c in out.columns}) == len(out.columns)
    assert quality.score_documents(no_docs, labels).count() == 0
    assert quality.score_documents(docs, labels.limit(0)).filter("score <> 0.5").count() == 0
    ones = labels.withColumn("quality", F.lit(1)).union(labels.withColumn("quality", F.lit(None).cast("int")))
    assert quality.score_documents(docs, ones).filter("predicted = 0").count() == 0


def test_targets_are_capped_and_shared_again():
    assert mixing.targets([10, 1000, 1000], [1, 2, 3]) == [30.0, pytest.approx(792.0), pytest.approx(1188.0)]
    assert mixing.targets([0, 50], [1, 2]) == [0.0, 50.0]
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [1, 2]) == [0.0, 0.0]
    assert sum(mixing.targets([5, 70, 900, 3], [1, 2, 3, 1])) == pytest.approx(978)


def test_quotas_are_exact_and_even():
    counts = [50, 0, 7, 1000]
    quotas = mixing.split_quotas(counts, 8, seed=3)
    assert quotas.sum(axis=0).tolist() == counts
    assert max(quotas.sum(axis=1)) - min(quotas.sum(axis=1)) <= 1
    assert (quotas == mixing.split_quotas(counts, 8, seed=3)).all()


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_mixture(request, which):
    frame = request.getfixturevalue(which)
    sizes, sources = Counter(), Counter()
    for r in frame.select("doc_id", "source", "text").collect():
        sizes[r["doc_id"]] += len(words_of(r["text"]))
        sources[r["source"]] += len(words_of(r["text"]))
    order = sorted(sources, key=lambda s: (s is None, (s or "").encode()))
    wanted = dict(zip(order, mixing.targets([sources[s] for s in order], [1 + i % 3 for i in range(len(order))])))
    mixed = mixing.mix(frame, n_shards=4)
    rows = mixed.collect()
    taken, by_doc = Counter(), Counter()
    for r in rows:
        taken[r["source"]] += r["mix_words"]
        by_doc[r["doc_id"]] += r["mix_words"]
    assert all(taken[s] == round(wanted[s]) for s in order)
    assert all(by_doc[d] <= 3 * sizes[d] for d in by_doc)
    assert {r["mix_shard"] for r in rows} <= set(range(4))
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(frame.repartition(3), n_shards=4).collect()))
    for r in mixing.cut_texts(mixed).filter("mix_words < mix_size").collect():
        assert len(words_of(r["text"])) == r["mix_words"]


def test_mixing_query_counts_words_by_row(spark, tmp_path):
    """Rows without an id, or that share one, report what the mix takes of each."""
    from larkspur.llm.queries import QUERIES

    rows = [(None if i % 5 == 0 else i // 4, "abc"[i % 3], "w " * (3 + i % 11)) for i in range(120)]
    rows += [(900, None, "one two"), (900, "a", None), (None, "b", "")]
    spark.createDataFrame(rows, "doc_id BIGINT, source STRING, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op5_mixing"](spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len(words_of(t))) for d, _, t in rows)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    totals = Counter()
    for r in got:
        totals[r["source_size"], r["target"]] += r["taken"]
    assert all(taken == round(target) for (_, target), taken in totals.items())
    frame = spark.createDataFrame([(d, s, len(words_of(t))) for d, s, t in rows], "doc_id BIGINT, source STRING, size BIGINT")
    taken = mixing.allocate(frame, size=F.col("size"))[0].select(
        "doc_id", "size", (F.col("_mix_passes") * F.col("mix_size") + F.col("_mix_part")).alias("taken")).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in got) == Counter(map(tuple, taken))


def test_empty_mixture(no_docs):
    assert mixing.mix(no_docs).count() == 0


def test_pipeline_stages(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    current = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, current, folder).cache()
        if name != names[-1]:
            assert after.columns == docs.columns
            assert after.select("doc_id").subtract(current.select("doc_id")).count() == 0
            assert after.filter("n_chars <> length(text)").count() == 0
        current = after
    run = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, run.collect())) == sorted(map(str, current.collect()))


def test_pipeline_on_an_empty_table(spark, folder, no_docs):
    import corpus_pipeline

    current = no_docs
    for _, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, folder)
    assert current.count() == 0
