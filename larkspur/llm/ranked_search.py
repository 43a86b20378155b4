"""Ranked lexical search: the best documents of every item, by branch and bound over document FP-trees.

Documents are restricted to the terms that any item asks for, as vectors of
``(term, tf)`` whose terms are numbered by falling document frequency.  A task
puts its vectors into a tree in which equal beginnings share a path.  Every
node knows, over all documents below it, the largest tf of each term, the least
``m`` (the length norm) and the least document id, which bound every score
below it from above.  Each item walks the tree depth first, the most promising
child first, and leaves a subtree as soon as its bound (with ids for equal
scores) cannot beat the item's worst kept document; what is left of at most
``LEAF`` documents is scored exactly.  Trees' lists are merged by windows.

Texts are read once for each block of items, to write their vectors; counts
(N, L, df) are sums over all documents.  Blocks hold ``items_per_block`` items
or, of longer ones, about ``bytes_per_block`` of text; the terms of one block
are all that the driver and the tasks hold.  No list of documents is cut.

NULL and empty texts have no terms and are in no list; an item without terms
has no rows; rows that repeat are items, or documents, of their own; equal
scores are ordered by document id, NULL last; other columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from larkspur.llm.common import map_texts, staged, text_bytes

# Documents that are scored together below a node, and documents of one tree.
LEAF, TREE = 32, 50_000
# Bytes of terms are digits, letters (A-Z lowered) and all beyond ASCII; others part them.
TERM_BYTES = bytes(ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else b if b > 127 else 32 for b in range(256))
# Fixed value: the scores' scale.
SCALE = 1_000_000_000


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def gain(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What terms add to a score; ``weights`` hold the item's repeats."""
    return weights * (SCALE * tf // (1000 * tf + 8 * m))


class Best:
    """The ``k`` best ``(score, id)`` so far, equal scores by id, NULL last."""

    def __init__(self, k: int):
        self.k, self.kept = k, []

    @staticmethod
    def key(score: int, doc_id: object) -> tuple:
        return -score, doc_id is None, 0 if doc_id is None else doc_id

    def hopeless(self, score: int, doc_id: object) -> bool:
        """Whether nothing of at most this score and at least this id gets in."""
        return score <= 0 or (len(self.kept) >= self.k and self.key(score, doc_id) >= self.kept[-1])

    def add(self, score: int, doc_id: object) -> None:
        bisect.insort(self.kept, self.key(score, doc_id))
        del self.kept[self.k:]

    def rows(self) -> list[tuple]:
        return [(-s, None if none else d) for s, none, d in self.kept]


class Tree:
    """An FP-tree of restricted vectors.

    Vectors stand in the order of their terms, so that a node is a stretch of
    them; paths without a fork are one node.  ``keys`` (node x terms + term) and
    ``most`` hold the largest tf of each term below each node.
    """

    def __init__(self, ids: list, m: np.ndarray, vectors: list[np.ndarray], tfs: list[np.ndarray], n_terms: int):
        self.n_terms = n_terms
        written = [v.astype(">u4").tobytes() for v in vectors]
        rank = {None: len(ids)} | {d: i for i, d in enumerate(sorted({d for d in ids if d is not None}))}
        self.id_of = sorted({d for d in ids if d is not None})
        norms = m.tolist()
        order = sorted(range(len(ids)), key=lambda i: (written[i], norms[i], rank[ids[i]]))
        self.ids, self.m = [ids[i] for i in order], m[order]
        self.id_rank = np.array([rank[d] for d in self.ids], dtype=np.int64)
        self.paths = [written[i] for i in order]
        self.sizes = np.array([len(vectors[i]) for i in order], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))
        self.term = np.concatenate([vectors[i] for i in order]).astype(np.int64) if order else np.zeros(0, dtype=np.int64)
        self.tf = np.concatenate([tfs[i] for i in order]).astype(np.int64) if order else np.zeros(0, dtype=np.int64)
        self._grow()

    def _children(self, low: int, high: int) -> list[tuple[int, int]]:
        """Stretches that a stretch falls into where its vectors part."""
        shared = 0
        a, b = self.paths[low], self.paths[high - 1]
        limit = min(len(a), len(b))
        while shared < limit and a[shared:shared + 4] == b[shared:shared + 4]:
            shared += 4
        own = low
        if len(a) == shared:
            own = bisect.bisect_right(self.paths, a, low, high)
        cuts = list(range(low, own, LEAF))
        at = own
        while at < high:
            cuts.append(at)
            # The next term's first vector.
            following = int.from_bytes(self.paths[at][shared:shared + 4], "big") + 1
            at = bisect.bisect_left(self.paths, a[:shared] + following.to_bytes(4, "big"), at, high)
        joined, cuts = [], cuts + [high]
        for begin, end in zip(cuts[:-1], cuts[1:]):
            # Small neighbours share a leaf.
            if joined and end - joined[-1][0] <= LEAF:
                joined[-1] = (joined[-1][0], end)
            else:
                joined.append((begin, end))
        return joined

    def _grow(self) -> None:
        low, high, child, last = [0], [len(self.ids)], [0], [0]
        node = 0
        while node < len(low):
            if high[node] - low[node] > LEAF:
                parts = self._children(low[node], high[node])
                child[node], last[node] = len(low), len(low) + len(parts)
                for begin, end in parts:
                    low.append(begin)
                    high.append(end)
                    child.append(0)
                    last.append(0)
            node += 1
        self.low, self.high, self.child, self.last = low, high, child, last
        keys, most, least_m, least_id = [None] * len(low), [None] * len(low), [0] * len(low), [0] * len(low)
        for node in reversed(range(len(low))):
            if child[node]:
                own = range(child[node], last[node])
                term, tf = np.concatenate([keys[c] for c in own]), np.concatenate([most[c] for c in own])
                least_m[node], least_id[node] = min(least_m[c] for c in own), min(least_id[c] for c in own)
            else:
                span = slice(self.first[low[node]], self.first[high[node]])
                term, tf = self.term[span], self.tf[span]
                least_m[node] = int(self.m[low[node]:high[node]].min()) if high[node] > low[node] else 0
                least_id[node] = int(self.id_rank[low[node]:high[node]].min()) if high[node] > low[node] else 0
            order = np.argsort(term, kind="stable")
            term, tf = term[order], tf[order]
            begins = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.zeros(0, dtype=np.int64)
            keys[node] = term[begins]
            most[node] = np.maximum.reduceat(tf, begins) if len(term) else tf
        counts = np.array([len(k) for k in keys])
        self.keys = np.repeat(np.arange(len(low)) * self.n_terms, counts) + np.concatenate(keys)
        self.most = np.concatenate(most)
        self.least_m, self.least_id = np.array(least_m, dtype=np.int64), least_id

    def _bounds(self, nodes: np.ndarray, wanted: np.ndarray, weights: np.ndarray) -> np.ndarray:
        asked = nodes[:, None] * self.n_terms + wanted[None, :]
        place = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        tf = np.where(self.keys[place] == asked, self.most[place], 0)
        return gain(weights[None, :], tf, self.least_m[nodes][:, None]).sum(axis=1)

    def _least(self, node: int) -> object:
        rank = self.least_id[node]
        return self.id_of[rank] if rank < len(self.id_of) else None

    def search(self, wanted: np.ndarray, weights: np.ndarray, by_term: np.ndarray, best: Best) -> int:
        """Put the best documents into ``best``; returns how many were scored.

        ``wanted`` and ``weights``: the item's different terms; ``by_term``: a
        row of zeros, one for each term, which is left as it was.
        """
        if not len(self.keys) or not len(wanted):
            return 0
        by_term[wanted] = weights
        scored, stack = 0, [(int(self._bounds(np.zeros(1, dtype=np.int64), wanted, weights)[0]), 0)]
        while stack:
            bound, node = stack.pop()
            if best.hopeless(bound, self._least(node)):
                continue
            if self.child[node]:
                children = np.arange(self.child[node], self.last[node])
                bounds = self._bounds(children, wanted, weights)
                # The best child is taken first, so it goes on the stack last.
                for i in np.lexsort((-children, bounds)).tolist():
                    if bounds[i] > 0:
                        stack.append((int(bounds[i]), int(children[i])))
            else:
                scored += self._score(node, by_term, best)
        by_term[wanted] = 0
        return scored

    def _score(self, node: int, by_term: np.ndarray, best: Best) -> int:
        low, high = self.low[node], self.high[node]
        span = slice(self.first[low], self.first[high])
        weights = by_term[self.term[span]]
        some = np.flatnonzero(weights)
        owner = np.repeat(np.arange(high - low), self.sizes[low:high])[some]
        gains = gain(weights[some], self.tf[span][some], self.m[low:high][owner])
        scores = np.zeros(high - low, dtype=np.int64)
        np.add.at(scores, owner, gains)
        for i in np.argsort(-scores, kind="stable").tolist():
            score = int(scores[i])
            if score <= 0 or (len(best.kept) >= best.k and -score > best.kept[-1][0]):
                break
            if not best.hopeless(score, self.ids[low + i]):
                best.add(score, self.ids[low + i])
        return high - low


def restricted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, terms, tfs)``: all terms' number of every document, and its counts of the vocabulary's."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found, counts = [], [], []
            for text in text_bytes(batch.column("text")):
                words = terms(text)
                sizes.append(len(words))
                held = Counter(map(vocabulary.get, words))
                held.pop(None, None)
                some = sorted(held)
                found.append(some)
                counts.append([held[t] for t in some])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                names=["doc_id", "n", "terms", "tfs"])

    return map_texts(docs.select("doc_id", "text"), count, f"doc_id {id_type}, n BIGINT, terms ARRAY<INT>, tfs ARRAY<INT>")


def _search_block(docs: DataFrame, items: list[tuple[object, Counter]], k: int, item_type: str) -> DataFrame:
    """``(item, item_id, doc_id, score)``: the ``k`` best of every tree for each item of a block."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, counts in items for t in counts}))}
    id_type = docs.schema["doc_id"].dataType.simpleString()
    vectors = staged(restricted(docs, vocabulary), "term-vectors")
    total = vectors.agg(F.sum((F.col("n") > 0).cast("long")).alias("N"), F.sum("n").alias("L")).first()
    n_docs, n_terms = total["N"] or 0, total["L"] or 0
    df = np.zeros(max(1, len(vocabulary)), dtype=np.int64)
    for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = n
    # Terms are numbered anew, the most frequent first.
    order = np.argsort(-df, kind="stable")
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    weights = np.array([weight(n_docs, int(d)) for d in df])
    asked = []
    for _, counts in items:
        own = np.array([vocabulary[t] for t in counts], dtype=np.int64)
        asked.append((number[own], weights[own] * np.array(list(counts.values()), dtype=np.int64)))

    def norm(n: int) -> int:
        return 100 - 75 + (75 * n * n_docs) // n_terms

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_term = np.zeros(len(order), dtype=np.int64)
        lists = [Best(k) for _ in asked]
        kind, held = None, ([], [], [], [])

        def run() -> None:
            tree = Tree(held[0], np.array(held[1], dtype=np.int64), held[2], held[3], len(order))
            for (wanted, own), best in zip(asked, lists):
                tree.search(wanted, own, by_term, best)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            doc_ids, sizes = batch.column("doc_id").to_pylist(), batch.column("n").to_pylist()
            found, tfs = batch.column("terms"), batch.column("tfs")
            flat, counts = number[found.flatten().to_numpy()], tfs.flatten().to_numpy()
            ends = np.concatenate(([0], np.cumsum(found.value_lengths().to_numpy())))
            for i in np.flatnonzero(np.diff(ends)).tolist():
                own, tf = flat[ends[i]:ends[i + 1]], counts[ends[i]:ends[i + 1]]
                by_number = np.argsort(own)
                for column, value in zip(held, (doc_ids[i], norm(sizes[i]), own[by_number], tf[by_number])):
                    column.append(value)
                if len(held[0]) >= TREE:
                    run()
                    held = ([], [], [], [])
        if held[0]:
            run()
        rows = [(item, score, doc_id) for item, best in enumerate(lists) for score, doc_id in best.rows()]
        if rows:
            item, score, doc_id = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc_id, kind), pa.array(score, pa.int64())],
                                             names=["item", "doc_id", "score"])

    found = vectors.mapInArrow(search, f"item INT, doc_id {id_type}, score BIGINT")
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], f"item INT, item_id {item_type}")
    return found.join(F.broadcast(names), "item")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, items_per_block: int = 2000,
                   bytes_per_block: int = 4 << 20) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents with a score above 0 of every item."""
    items = items.select("item_id", "text")
    item_type = items.schema["item_id"].dataType.simpleString()
    size = items.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n_blocks = max(1, -(-size["rows"] // items_per_block), -(-(size["bytes"] or 0) // bytes_per_block))
    block = F.pmod(F.xxhash64("item_id", "text", F.lit(3)), F.lit(n_blocks))
    found = []
    for number in range(n_blocks):
        rows = items.filter(block == number).toLocalIterator()
        own = [(r["item_id"], Counter(terms((r["text"] or "").encode()))) for r in rows]
        found.append(_search_block(docs, own, k, item_type).withColumn("block", F.lit(number)))
    every = reduce(DataFrame.unionByName, found)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # Lists meet in parts first, so that no task gets a row from every tree for an item.
    part = F.pmod(F.spark_partition_id(), F.lit(64))
    by_part = Window.partitionBy("block", "item", "part").orderBy(*order)
    by_item = Window.partitionBy("block", "item").orderBy(*order)
    few = every.withColumn("part", part).withColumn("place", F.row_number().over(by_part)).filter(F.col("place") <= k).drop("place")
    ranked = few.withColumn("rank", F.row_number().over(by_item)).filter(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
