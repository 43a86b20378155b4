"""Quality classifier: a sparse ensemble of conjunctive rules.

Statistics of whole texts are the only inputs.  A random forest is grown on a
labelled sample, every path from a root to a node becomes a rule (a
conjunction of threshold tests), a logistic regression with an L1 penalty
weighs the rules, and those that keep a weight are compiled into one Spark
column expression, so scoring is a projection over the statistics.

The sample is bounded (``max_sample`` labelled rows, those of smallest id
hash, a documented limit of the fit alone); every row is scored.  NULL texts
count as empty; empty texts have all statistics 0 and a score like any other;
an id that several rows share keeps all of them; labels that are NULL are not
learned from; with no labels, or one class only, the score is that class's
share (0.5 without labels).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.llm.common import map_texts, staged, text_bytes, without
from larkspur.llm.html_text import STOP_WORDS

STATISTICS = (
    "st_words", "st_word_bytes", "st_lines", "st_line_words", "st_letters", "st_upper", "st_digits", "st_marks",
    "st_symbols", "st_pipes", "st_bangs", "st_stops", "st_distinct", "st_top_word", "st_twin_lines", "st_spaces",
    "st_sentences", "st_marked_words")
_STOPS = frozenset(w.encode() for w in STOP_WORDS)
_MARKED = re.compile(rb"[^\w\s\x80-\xff.,;:'\"()-]+(?=\s|\Z)")


def _classes() -> np.ndarray:
    """Which bytes are letters, capitals, digits, punctuation, symbols, white space."""
    table = np.zeros((256, 6))
    for code in range(256):
        char = chr(code)
        ascii_char = code < 128
        table[code] = (
            not ascii_char or char.isalpha(), ascii_char and char.isupper(), ascii_char and char.isdigit(),
            char in ".,;:'\"()-?!", ascii_char and char.isprintable() and not char.isalnum() and char not in " .,;:'\"()-?!",
            char in " \t\n\r\v\f")
    return table


CLASSES = _classes()


def statistics_of(text: bytes) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``; ratios of nothing are 0."""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    histogram = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    letters, upper, digits, marks, symbols, spaces = histogram @ CLASSES
    lines = [line for line in text.split(b"\n") if line.strip()]
    counts = Counter(words)
    twins = sum(len(line) * k for line, k in Counter(lines).items() if k > 1)
    stops = sum(k for w, k in counts.items() if w.lower().strip(b".,;:!?") in _STOPS)
    return [float(n), (size - spaces) / n, float(len(lines)), n / len(lines), letters / size, upper / max(letters, 1.0),
            digits / size, marks / size, symbols / size, histogram[124] / n, histogram[33] / n, stops / n,
            len(counts) / n, max(counts.values()) / n, twins / size, spaces / size, histogram[46] / n,
            len(_MARKED.findall(text)) / n]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the statistics of ``text``; columns of these names are replaced."""
    base = without(docs, STATISTICS)
    out = base.withColumns({s: F.lit(0.0) for s in STATISTICS}).schema

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([statistics_of(t) for t in text_bytes(batch.column("text"))]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(values[:, i]) for i in range(len(STATISTICS)))],
                names=[*batch.schema.names, *STATISTICS])

    return map_texts(base, measure, out)


@dataclass(frozen=True)
class Rule:
    """A conjunction: every ``(statistic, above, threshold)`` test holds."""

    tests: tuple

    def column(self) -> Column:
        parts = [F.col(s) > t if above else F.col(s) <= t for s, above, t in self.tests]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole & part
        return whole

    def __str__(self) -> str:
        return " and ".join(f"{s} {'>' if above else '<='} {t:.6g}" for s, above, t in self.tests)


@dataclass(frozen=True)
class RuleModel:
    """Rules with weights; the score is the logistic function of their sum."""

    rules: tuple
    weights: tuple
    intercept: float

    def score(self) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(rule.column(), float(weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(forest) -> list[Rule]:
    """Rules of all root-to-node paths of a fitted forest, each once.

    Tests of one statistic in one direction are merged into the tightest.
    """
    found: dict[Rule, None] = {}

    def walk(node, tests: tuple) -> None:
        if tests:
            tightest: dict[tuple, float] = {}
            for name, above, at in tests:
                key = (name, above)
                tightest[key] = at if key not in tightest else (max if above else min)(at, tightest[key])
            found[Rule(tuple((s, a, t) for (s, a), t in sorted(tightest.items())))] = None
        if node.subtreeDepth() > 0:
            name, at = STATISTICS[node.split().featureIndex()], float(node.split().threshold())
            walk(node.leftChild(), (*tests, (name, False, at)))
            walk(node.rightChild(), (*tests, (name, True, at)))

    for tree in forest._call_java("trees"):
        walk(tree.rootNode(), ())
    return list(found)


def sample_labels(labels: DataFrame, label: str, max_sample: int, seed: int) -> DataFrame:
    """At most so many labelled ids, those of least hash."""
    known = labels.filter(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("double").alias("label"))
    return known.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "label").limit(max_sample)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_sample: int = 20_000, n_trees: int = 12,
        depth: int = 3, penalty: float = 0.001, seed: int = 0) -> RuleModel:
    """Learn rules from ``(doc_id, text)`` and labels 0/1 by ``doc_id``.

    The sample of ids is small by its bound, so it is sent to the scan, and
    only texts in it are measured.
    """
    ids = F.broadcast(sample_labels(labels, label, max_sample, seed))
    sample = with_statistics(docs.select("doc_id", "text").join(ids, "doc_id")).select("label", "doc_id", *STATISTICS)
    sample = staged(staged(sample, "rules-rows").coalesce(1).sortWithinPartitions("doc_id", "label", *STATISTICS).drop("doc_id"), "rules-sample")
    share = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(share) < 2:
        odds = {(): 0.0, (0.0,): -20.0, (1.0,): 20.0}[tuple(share)]
        return RuleModel((), (), odds)
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(sample).select("features", "label")
    forest = RandomForestClassifier(numTrees=n_trees, maxDepth=depth, maxBins=64, seed=seed,
                                    featureSubsetStrategy="onethird", minInstancesPerNode=5).fit(vectors)
    rules = tree_rules(forest)
    held = sample.select("label", F.array(*[F.when(r.column(), 1.0).otherwise(0.0) for r in rules]).alias("a"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False).fit(
        held.select("label", array_to_vector("a").alias("features")))
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w]
    return RuleModel(tuple(r for r, _ in kept), tuple(w for _, w in kept), float(lasso.intercept))


def held_out(doc_id: Column) -> Column:
    """The fifth of the ids whose CRC-32 (of the id as text) divides by five; NULL ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3,
                    **settings) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``; columns of these names are replaced.

    Learns from labelled documents that are not held out, then measures and
    scores every document in one pass without a shuffle.
    """
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"))), label, **settings)
    base = without(docs, ["held_out", "score", "predicted", *STATISTICS])
    scored = with_statistics(base).withColumn("score", model.score())
    return scored.select(*base.columns, held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
