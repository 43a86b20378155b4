"""Document fingerprints: digests of improbable features in chained Bloom filters.

A feature is a window of 64 bytes.  Windows are ranked by the rarity of their
entropy (how few windows of all texts have it; the extremes are left out as
too plain or too random), a window that is the rarest in a quarter or more of
the 64-window neighbourhoods around it is selected, and the selected ones go
into 2048-bit Bloom filters, five bits each; a filter with 160 features is
full and the next one is chained to it.  Two digests are compared filter by
filter: bits in common, beyond what chance gives, over the bits of the smaller.

Entropies of all windows are found together by array arithmetic, as changes
from one window to the next.  Each text is digested where it lies; the only
shuffle brings documents into id order for those who ask for neighbours.

Texts are UTF-8 bytes, NULL counts as empty.  An empty text has an empty
fingerprint; a text shorter than a window, or without any selected one, is one
feature itself; equal texts have equal fingerprints; the likeness of equal
fingerprints is 1, that of an empty and another one 0.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from larkspur.llm.anchors import Hasher, _sliding_least, chunks
from larkspur.llm.common import map_texts, sha256_hex, text_bytes

# Settings of the digest.
WIDTH, NEAR, POPULAR, BITS, FULL, PROBES = 64, 64, 16, 2048, 160, 5
BINS, LOWEST, HIGHEST = 1001, 100, 990
# Share of the way from chance to full overlap that counts as nothing in common.
CUTOFF = 0.15
_SCALE = 1 << 20
_TERMS = np.array([0] + [round(c * math.log2(c) * _SCALE) for c in range(1, WIDTH + 1)], dtype=np.int64)


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """Entropy, scaled to 0..1000, of every window of the buffer."""
    n = len(data) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    ahead, behind = np.zeros(len(data), dtype=np.uint8), np.zeros(len(data), dtype=np.uint8)
    for d in range(1, WIDTH):
        same = (data[:-d] == data[d:]).view(np.uint8)
        ahead[:-d] += same
        behind[d:] += same
    leaving, entering = ahead[:n - 1].astype(np.int64) + 1, behind[WIDTH:].astype(np.int64)
    change = _TERMS[leaving - 1] - _TERMS[leaving] + _TERMS[entering + 1] - _TERMS[entering]
    first = _TERMS[np.bincount(data[:WIDTH], minlength=256)].sum()
    sums = np.concatenate(([first], first + np.cumsum(change)))
    most = int(math.log2(WIDTH)) * WIDTH * _SCALE
    return (most - sums) * (BINS - 1) // most


def _laid_out(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One padded buffer, where texts begin, and how many windows each has."""
    pad = b"\0" * WIDTH
    data = np.frombuffer(pad + b"".join(texts) + pad, dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = WIDTH + np.concatenate(([0], np.cumsum(sizes)))[:-1]
    return data, first, np.maximum(sizes - WIDTH + 1, 0)


def _inside(first: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Which windows of a buffer lie inside one text."""
    steps = np.zeros(size + 1, dtype=np.int64)
    some = counts > 0
    np.add.at(steps, first[some], 1)
    np.add.at(steps, first[some] + counts[some], -1)
    return np.cumsum(steps[:-1]) > 0


def count_entropies(docs: DataFrame) -> np.ndarray:
    """How many windows of all texts have each entropy."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, dtype=np.int64)
        for batch in batches:
            texts = list(text_bytes(batch.column("text")))
            for low, high in chunks(texts):
                data, first, counts = _laid_out(texts[low:high])
                bins = entropy_bins(data)
                total += np.bincount(bins[_inside(first, counts, len(bins))], minlength=BINS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bin", "n"])

    rows = map_texts(docs.select("text"), count, "bin INT, n BIGINT").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(BINS, dtype=np.int64)
    for row in rows:
        found[row["bin"]] = row["n"]
    return found


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy, the rarest 0; those left out rank last of all."""
    order = np.argsort(counts, kind="stable")
    ranks = np.empty(BINS, dtype=np.int64)
    ranks[order] = np.arange(BINS)
    ranks[:LOWEST] = ranks[HIGHEST + 1:] = BINS
    return ranks


def digest(texts: Sequence[bytes], ranks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Filters (rows of 32 64-bit words) and their numbers of features, of each text."""
    found = []
    for low, high in chunks(texts):
        found += _digest(texts[low:high], ranks)
    return found


def _digest(texts: Sequence[bytes], ranks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    data, first, counts = _laid_out(texts)
    bins = entropy_bins(data)
    rank = np.where(_inside(first, counts, len(bins)), ranks[bins], BINS)
    # At least 63 windows outside any text stand before, between and after texts,
    # so no neighbourhood sees two texts.
    place = np.arange(len(rank) + NEAR)
    bits = int(len(place)).bit_length()
    keys = (np.concatenate((rank, np.full(NEAR, BINS))) << bits) | place
    best = _sliding_least(keys, NEAR) & ((1 << bits) - 1)
    popular = np.bincount(best, minlength=len(place))[:len(rank)]
    chosen = np.flatnonzero((popular >= POPULAR) & (rank < BINS))
    owner = np.searchsorted(first, chosen, side="right") - 1
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    per_text = np.bincount(owner, minlength=len(texts))
    bare = np.flatnonzero((per_text == 0) & (sizes > 0))
    begin = np.concatenate((chosen, first[bare]))
    end = np.concatenate((chosen + WIDTH, first[bare] + sizes[bare]))
    owner = np.concatenate((owner, bare))
    order = np.lexsort((begin, owner))
    begin, end, owner = begin[order], end[order], owner[order]
    per_text[bare] = 1
    ordinal = np.arange(len(owner)) - (np.cumsum(per_text) - per_text)[owner]
    n_filters = -(-per_text // FULL)
    first_filter = np.cumsum(n_filters) - n_filters
    row = first_filter[owner] + ordinal // FULL
    hashed = Hasher(data, 0)(begin, end)
    table = np.zeros((int(n_filters.sum()), BITS), dtype=np.uint8)
    for probe in range(PROBES):
        table[row, (hashed >> np.uint64(11 * probe)) & np.uint64(BITS - 1)] = 1
    packed = np.packbits(table, axis=1).view(np.uint64)
    features = np.bincount(row, minlength=len(table))
    return [(packed[f:f + n], features[f:f + n]) for f, n in zip(first_filter, n_filters)]


def as_string(print_: tuple[np.ndarray, np.ndarray]) -> str:
    """A fingerprint as text: per filter the number of features and its bits in base 64."""
    return ",".join(f"{n}:{base64.b64encode(bits.tobytes()).decode()}" for bits, n in zip(*print_))


def from_string(value: str) -> tuple[np.ndarray, np.ndarray]:
    parts = [p.split(":") for p in value.split(",") if p]
    rows = b"".join(base64.b64decode(b) for _, b in parts)
    return np.frombuffer(rows, dtype=np.uint64).reshape(-1, BITS // 64), np.array([int(n) for n, _ in parts], dtype=np.int64)


def likeness(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Likeness of two fingerprints, 0 to 1: the mean, over the filters of the
    shorter, of the best normalised overlap with a filter of the other."""
    (a, _), (b, _) = (one, two) if len(one[0]) <= len(two[0]) else (two, one)
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a):
        return 0.0
    size_a, size_b = np.bitwise_count(a).sum(axis=1).astype(float), np.bitwise_count(b).sum(axis=1).astype(float)
    common = np.array([np.bitwise_count(f & b).sum(axis=1) for f in a], dtype=float)
    most = np.minimum(size_a[:, None], size_b[None, :])
    chance = size_a[:, None] * size_b[None, :] / BITS
    least = chance + CUTOFF * (most - chance)
    scores = np.clip((common - least) / np.maximum(most - least, 1e-9), 0.0, 1.0)
    if len(a) == len(b):
        return float(max(scores.max(axis=1).mean(), scores.max(axis=0).mean()))
    return float(scores.max(axis=1).mean())


def fingerprints(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """``(doc_id, fingerprint)`` of every document, without a shuffle."""
    ranks = rarity(count_entropies(docs)) if ranks is None else ranks
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = digest(list(text_bytes(batch.column("text"))), ranks)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([as_string(f) for f in found], pa.string())],
                                             names=["doc_id", "fingerprint"])

    return map_texts(docs.select("doc_id", "text"), emit, f"doc_id {id_type}, fingerprint STRING")


def in_id_order(docs: DataFrame, rows_per_bucket: int = 5000) -> DataFrame:
    """Documents in buckets of neighbouring ids, each followed by the first of the next bucket.

    Rows come sorted within partitions; ``borrowed`` marks the copies that
    stand behind a bucket.  The first bucket follows the last; NULL ids are
    last; buckets grow with the root of the table, so their bounds (the only
    thing the driver sees) stay few.
    """
    rows = docs.count()
    n = max(1, math.ceil(rows / max(rows_per_bucket, math.isqrt(rows))))
    numbered = docs.select("doc_id", "text", F.col("doc_id").cast("double").alias("_at"))
    cuts = sorted(set(numbered.approxQuantile("_at", [i / n for i in range(1, n)], 0.25 / n))) if n > 1 and rows else []
    if cuts:
        split = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_at", outputCol="bucket", handleInvalid="keep")
        numbered = split.transform(numbered).withColumn("bucket", F.col("bucket").cast("int"))
    else:
        numbered = numbered.withColumn("bucket", F.lit(0))
    heads = sorted((r["bucket"], r["first"]) for r in numbered.groupBy("bucket").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first")).collect())
    before = [(heads[i - 1][0], first["doc_id"]) for i, (_, first) in enumerate(heads)]
    borrowed = docs.sparkSession.createDataFrame(
        before, f"bucket INT, _id {docs.schema['doc_id'].dataType.simpleString()}")
    own = numbered.select("bucket", F.lit(False).alias("borrowed"), "doc_id", "text")
    behind = docs.select("doc_id", "text").join(F.broadcast(borrowed), F.col("doc_id").eqNullSafe(F.col("_id"))).select(
        "bucket", F.lit(True).alias("borrowed"), "doc_id", "text")
    # One partition a bucket: hashed numbers would put several into one task.
    return own.union(behind).repartitionById(n + 1, F.col("bucket")).sortWithinPartitions(
        "bucket", "borrowed", F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))


def compare_with_next(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and likenesses.

    The edited text replaces the last half of the characters by as many, or
    all, of the next document's first ones.  Equal rows share one place in the
    order, each followed by the next.
    """
    ranks = rarity(count_entropies(docs)) if ranks is None else ranks
    ordered = in_id_order(docs)
    id_type = ordered.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def settle(rows: list[tuple]) -> list[tuple]:
        """Results of all rows but the last, whose next one is not known yet."""
        texts = [text for _, _, text in rows]
        prints = digest(texts, ranks)
        strings = [t.decode() for t in texts]
        half = [len(s) // 2 for s in strings]
        edited = [(strings[i][:len(strings[i]) - half[i]] + strings[i + 1][:half[i]]).encode() for i in range(len(rows) - 1)]
        edited_prints = digest(edited, ranks)
        return [(doc_id, len(strings[i]), sha256_hex(edited[i]), as_string(prints[i]), as_string(edited_prints[i]),
                 likeness(prints[i], edited_prints[i]), likeness(prints[i], prints[i + 1]))
                for i, (borrowed, doc_id, _) in enumerate(rows[:-1]) if not borrowed]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        held, size = [], 0
        for batch in batches:
            types[0] = batch.schema.field("doc_id").type
            for row in zip(batch.column("borrowed").to_pylist(), batch.column("doc_id").to_pylist(), text_bytes(batch.column("text"))):
                held.append(row)
                size += len(row[2])
                if size > 1 << 21 or len(held) > 1000:
                    done = settle(held)
                    held, size = held[-1:], len(held[-1][2])
                    if done:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
        if len(held) > 1 and (done := settle(held)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    return map_texts(ordered, emit, f"doc_id {id_type}, n_chars BIGINT, edited_sha256 STRING, fingerprint STRING, "
                                    "edited_fingerprint STRING, near_edited DOUBLE, near_next DOUBLE")
