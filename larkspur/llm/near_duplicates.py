"""N-gram Jaccard join: a MinHash LSH forest, then exact verification.

1. Equal texts are one node, whatever their number.
2. Each text is a set of shingles (``words`` consecutive words).  In each of
   ``trees`` trees it has a signature: ``max_depth`` labels of a byte, each
   cut from a MinHash value.
3. Signatures of all trees are sorted, over all partitions; a sorted tree is a
   prefix trie, whose nodes are stretches of neighbours with a common prefix.
   Matches begin at whole signatures, and prefixes shorten level by level:
   only the heads of the groups found so far are linked at the next level, so
   deep groups are not grouped again.  Shortening ends at the depth at which a
   pair at the threshold meets in one of the trees with probability ``recall``
   or more.  A node of ``n`` texts gives ``n - 1`` links in all, and is split
   over as many partitions as it fills; the partitions' first and last rows
   link it across their boundaries.
4. Components of these links are groups that hold every candidate pair.
   Groups are verified exactly, on whole shingle sets: a group beyond
   ``block`` texts is cut into blocks and each pair of blocks is one task.
   Tasks give counts of links and a spanning forest, never pairs.

Words are runs of anything but the six ASCII white-space characters.  Texts
with fewer words than a shingle are one shingle; texts without words (NULL,
empty) are like their equals only; rows with equal ids are separate documents;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from larkspur.llm.anchors import Hasher, Words, chunks
from larkspur.llm.common import blocks, map_texts, staged, text_bytes, without
from larkspur.llm.components import components

OUT = ("class_id", "n_links", "n_copies")
# Leading bytes of a signature that name its tree.
TREE_BYTES = 2


def found_with(similarity: float, trees: int, depth: int) -> float:
    """Probability that one of the trees joins a pair of this similarity at this depth."""
    return 1.0 - (1.0 - similarity ** depth) ** trees


def prefix_depth(threshold: float, trees: int, max_depth: int, recall: float) -> int:
    """The depth at which shortening ends: the longest prefix that finds pairs at the threshold with the target recall."""
    depth = max_depth
    while depth > 1 and found_with(threshold, trees, depth) < recall:
        depth -= 1
    if found_with(threshold, trees, depth) < recall:
        raise ValueError("too few trees for this recall")
    return depth


def shingles(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of texts, and where each text's begin."""
    words = Words(texts)
    counts = np.diff(words.first)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(n)))
    owner = np.repeat(np.arange(len(texts)), n)
    low = words.first[owner] + np.arange(first[-1]) - first[owner]
    high = np.minimum(low + size, words.first[owner + 1])
    if not len(low):
        return np.zeros(0, dtype=np.uint64), first
    return Hasher(words.data, 0)(words.start[low], words.end[high - 1]), first


def _signer(size: int, trees: int, depth: int, seed: int):
    """Signatures of every text: the tree's number in two bytes, then a byte a level."""
    rng = np.random.default_rng(seed)
    masks = rng.integers(0, 2**63, trees * depth, dtype=np.uint64)
    odd = rng.integers(0, 2**63, trees * depth, dtype=np.uint64) | np.uint64(1)
    step = np.uint64(0x9E3779B97F4A7C15)
    width = TREE_BYTES + depth
    numbers = np.arange(trees, dtype=">u2").view(np.uint8).reshape(trees, TREE_BYTES)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, 4 << 20):
            texts = list(text_bytes(batch.column("text")))
            labels = np.empty((len(texts), trees, width), dtype=np.uint8)
            labels[:, :, :TREE_BYTES] = numbers
            some = np.zeros(len(texts), dtype=bool)
            for low, high in chunks(texts):
                values, first = shingles(texts[low:high], size)
                filled = np.flatnonzero(np.diff(first))
                if not len(filled):
                    continue
                some[low + filled] = True
                begins = first[filled]
                for i in range(trees * depth):
                    hashed = (values ^ masks[i]) * odd[i]
                    hashed ^= hashed >> np.uint64(32)
                    labels[low + filled, i // depth, TREE_BYTES + i % depth] = (np.minimum.reduceat(hashed, begins) * step) >> np.uint64(56)
            flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), int(some.sum()) * trees, [None, pa.py_buffer(labels[some].tobytes())])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(some * trees))).astype(np.int32)), flat.cast(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("doc_id"), lists], names=["node", "doc_id", "signatures"])

    return sign


def common_prefixes(signatures: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """Labels that each of the sorted signatures shares with the one before it; -1 in another tree."""
    last = signatures[:1] ^ 1 if before is None else before[None, :]
    same = signatures == np.concatenate((last, signatures[:-1]))
    return np.maximum(np.logical_and.accumulate(same, axis=1).sum(axis=1) - TREE_BYTES, -1)


def _trie_links(width: int, depth: int):
    """Links of the trie that sorted rows of a partition make, and the partition's first and last row."""
    levels = range(width - TREE_BYTES, depth - 1, -1)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, heads, edge = None, {}, None
        for table in _joined_rows(batches, 1 << 16):
            rows = table.column("signature").combine_chunks().cast(pa.binary(width))
            signatures = np.frombuffer(rows.buffers()[1], dtype=np.uint8)[rows.offset * width:][:len(rows) * width].reshape(-1, width)
            nodes = table.column("node").to_pylist()
            common = common_prefixes(signatures, before)
            if before is None:
                yield _link_rows([nodes[0]], [None], [signatures[0].tobytes()])
            u, v = [], []
            for level in levels:
                # Rows that begin a group one level deeper, and join one here.
                head = np.maximum.accumulate(np.where(common < level, np.arange(len(nodes)), -1))
                for i in np.flatnonzero(common == level):
                    u.append(nodes[i])
                    v.append(nodes[head[i]] if head[i] >= 0 else heads[level])
                if head[-1] >= 0:
                    heads[level] = nodes[head[-1]]
            yield _link_rows(u, v, [None] * len(u))
            before, edge = signatures[-1].copy(), nodes[-1]
        if before is not None:
            yield _link_rows([edge], [None], [before.tobytes()])

    return link


def _link_rows(u: list, v: list, signatures: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in (u, v, signatures)], names=["u", "v", "signature"])


def _joined_rows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def forest_links(signatures: DataFrame, max_depth: int, depth: int) -> DataFrame:
    """Links ``(u, v)`` that join all nodes of a trie at ``depth``, for rows ``(node, signature)``."""
    ordered = signatures.repartitionByRange("signature", "node").sortWithinPartitions("signature", "node")
    found = staged(ordered.mapInArrow(_trie_links(TREE_BYTES + max_depth, depth), "u BINARY, v BINARY, signature BINARY"), "trie-links")
    # Two rows a partition: a node that goes on in the next partition is linked there.
    edges = found.filter("v IS NULL")
    order = Window.partitionBy(F.substring("signature", 1, TREE_BYTES)).orderBy("signature", "u")
    prefix = F.substring("signature", 1, TREE_BYTES + depth)
    across = edges.select("u", F.lag("u").over(order).alias("v"), (prefix == F.lag(prefix).over(order)).alias("same")).filter("same")
    return found.filter("v IS NOT NULL").select("u", "v").union(across.select("u", "v")).filter("u <> v").distinct()


def _verifier(size: int, threshold: float):
    """Exact links within a group, or between two blocks of one."""

    def verify(table: pa.Table) -> pa.Table:
        texts = list(text_bytes(table.column("text")))
        side = table.column("side").to_numpy()
        m = len(texts)
        values, owners, counts = [], [], np.zeros(m)
        for low, high in chunks(texts):
            found, first = shingles(texts[low:high], size)
            for i in range(high - low):
                own = np.unique(found[first[i]:first[i + 1]])
                values.append(own)
                owners.append(np.full(len(own), low + i))
                counts[low + i] = len(own)
        values, owners = np.concatenate(values), np.concatenate(owners)
        # Shingles of one text only are in no intersection.
        shared, column, uses = np.unique(values, return_inverse=True, return_counts=True)
        wide = np.flatnonzero(uses > 1)
        place = np.full(len(shared), -1)
        place[wide] = np.arange(len(wide))
        column = place[column]
        owners, column = owners[column >= 0], column[column >= 0]
        order = np.argsort(column, kind="stable")
        owners, column = owners[order], column[order]
        common = np.zeros((m, m), dtype=np.float32)
        width = 4096
        for first in range(0, len(wide), width):
            part = slice(*np.searchsorted(column, [first, first + width]))
            rows = np.zeros((m, min(width, len(wide) - first)), dtype=np.float32)
            rows[owners[part], column[part] - first] = 1
            common += rows @ rows.T
        union = counts[:, None] + counts[None, :] - common
        linked = (common >= threshold * union - 1e-6) & (common > 0)
        np.fill_diagonal(linked, False)
        if len(np.unique(side)) > 1:
            # Pairs inside a block are another task's.
            linked &= side[:, None] != side[None, :]
        # Spread the least place over each component.
        root = np.arange(m)
        while True:
            least = np.minimum(root, np.where(linked, root[None, :], m).min(axis=1))
            least = least[least]
            if (least == root).all():
                break
            root = least
        nodes = table.column("node").combine_chunks()
        out = np.flatnonzero(linked.any(axis=1))
        return pa.table({"node": nodes.take(pa.array(out)), "root": nodes.take(pa.array(root[out])),
                         "links": pa.array(linked.sum(axis=1)[out].astype(np.int64))})

    return verify


def similar_classes(docs: DataFrame, threshold: float = 0.8, words: int = 5, trees: int = 30, max_depth: int = 12,
                    recall: float = 0.999, block: int = 512, seed: int = 0) -> DataFrame:
    """``(doc_id, node, root, class_id, n_links, n_copies)``, one row per document.

    ``node`` is the text's MD5 and ``root`` the least of its class.  Documents whose texts are linked, directly or
    through others, share a class, named by its least ``doc_id``.  ``n_links``
    counts the different texts that are similar to this one, ``n_copies`` the
    other documents with an equal text.
    """
    node = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    depth = prefix_depth(threshold, trees, max_depth, recall)
    named = docs.select("doc_id", node.alias("node"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    signed = staged(map_texts(named, _signer(words, trees, max_depth, seed),
                              f"node BINARY, doc_id {id_type}, signatures ARRAY<BINARY>"), "signatures")
    copies = signed.groupBy("node").agg(F.count("*").alias("n"), F.min("doc_id").alias("least_id"))
    different = signed.groupBy("node").agg(F.first("signatures").alias("signatures"))
    links = forest_links(different.select("node", F.explode("signatures").alias("signature")), max_depth, depth)
    groups = staged(components(links), "groups")
    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    # One document carries each text into the verification.
    carriers = groups.join(copies, "node").join(sizes, "root").select(
        F.col("node").alias("_node"), "least_id", "root", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("side"))
    carried = (
        carriers.withColumn("row", F.xxhash64("_node", "least_id"))
        .join(named.withColumn("row", F.xxhash64("node", "doc_id")), "row")
        .filter((F.col("_node") == F.col("node")) & F.col("least_id").eqNullSafe(F.col("doc_id")))
        .groupBy("row", "node").agg(*(F.first(c).alias(c) for c in ("root", "blocks", "side", "text")))
    )
    pairs = carried.select("root", "node", "text", "side", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "root", F.least("side", "other").alias("one"), F.greatest("side", "other").alias("two"), "node", "side", "text")
    verified = staged(pairs.groupBy("root", "one", "two").applyInArrow(
        _verifier(words, threshold), "node BINARY, root BINARY, links BIGINT"), "verified")
    links = verified.groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = components(verified.select(F.col("node").alias("u"), F.col("root").alias("v")))
    texts = copies.join(links, "node", "left").join(classes, "node", "left").select(
        "node", "n", "least_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "node").alias("root"))
    named_classes = texts.groupBy("root").agg(F.min("least_id").alias("class_id"))
    per_text = texts.join(named_classes, "root").select("node", "root", "class_id", "n_links", (F.col("n") - 1).alias("n_copies"))
    return signed.select("doc_id", "node").join(per_text, "node").select("doc_id", "node", "root", "class_id", "n_links", "n_copies")


def keep_one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """One document of each class: that with the least ``doc_id``; columns stay as they are."""
    inner = without(docs, ["_node", "_first"])
    node = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    found = staged(similar_classes(docs, **settings), "classes")
    rows = found.groupBy("root", "node", "doc_id").agg(F.count("*").alias("same"))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node", "same")).alias("first"))
    chosen = first.select(F.col("first.node").alias("_node"), F.col("first.doc_id").alias("_first"), F.col("first.same").alias("_same"))
    kept = inner.join(chosen, (node == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_first")))
    once = kept.filter("_same = 1").drop("_node", "_first", "_same")
    repeated = kept.filter("_same > 1").dropDuplicates(["_node", "_first"]).drop("_node", "_first", "_same")
    return once.union(repeated)
