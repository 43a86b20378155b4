"""Find all repeated windows of long texts, with few rows and no pairs.

1. Every run of windows that shares an anchor (:mod:`anchors`) is one row:
   the anchor's hash, the hash of the whole span of the run, and its place.
   Runs that repeat inside a batch of texts are settled there, so a batch
   ships a repeated span once, however many copies it holds.
2. Rows meet by anchor.  A span that occurs elsewhere covers all of its
   windows at once.  Anchors with one span only are done.
3. Only where one anchor has several spans (the edges of repeats, near
   copies) the spans' units are shipped, still by anchor.  There all spans of
   an anchor are sorted from it on, to the right and to the left, one unit at
   a time, and only spans that still agree with another go on: so every match
   is extended both ways to its end, without a pair of spans being formed.  A
   window is repeated where a stretch to the left and one to the right that
   fill it are shared together.
   An anchor with more than ``wide`` spans is not compared in one task: its
   windows become rows, counted by their 128-bit hashes with partial sums.

Extension compares units (bytes, or words by 128-bit hashes); all other steps
are exact up to 128-bit hash equality, and 64-bit anchors only gather
candidates.  Texts are told apart by ``xxhash64(doc_id, text)``, so rows that
share an id are separate texts unless they are equal, and equal ones get one
and the same answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from larkspur.llm.anchors import Hasher, Words, chunks, merge_ranges, runs
from larkspur.llm.common import blocks, map_texts, staged, text_bytes

NO_ID = np.iinfo(np.int64).max
# Bytes of text within which repeated spans are settled before anything is shipped.
BLOCK_BYTES = 6 << 20


@dataclass(frozen=True)
class Repeats:
    """What counts as a repeat.

    ``words``: units are words, else bytes.  ``earlier``: only windows that
    also start in a text with a smaller id are covered (a NULL id is smaller
    than none); else those that start anywhere else.
    """

    words: bool
    size: int
    anchor: int
    earlier: bool
    wide: int = 4096
    lead: bool = False  # deal spans by ranges of their anchors' leading bytes (units are bytes)

    def __post_init__(self):
        if self.size - self.anchor > 0xFFFF:
            raise ValueError("a window is at most 65,535 units longer than its anchor")

    def buffer(self, texts: list[bytes]):
        """Bytes, unit starts, unit ends (both None for bytes), and first units of texts."""
        if self.words:
            found = Words(texts)
            return found.data, found.start, found.end, found.first
        return np.frombuffer(b"".join(texts), dtype=np.uint8), None, None, np.cumsum([0] + [len(t) for t in texts])


def cover_lists(text: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """Maximal ranges of each text that has any, as one list a text."""
    low, high = merge_ranges((text.astype(np.int64) << 32) + low, (text.astype(np.int64) << 32) + high)
    owner = low >> 32
    texts, begins = np.unique(owner, return_index=True)
    values = pa.StructArray.from_arrays(
        [pa.array((x - (owner << 32)).astype(np.int32)) for x in (low, high)], ["lo", "hi"])
    return texts, pa.ListArray.from_arrays(pa.array(np.append(begins, len(owner)).astype(np.int32)), values)


def covered_mask(lists: pa.ListArray | pa.ChunkedArray, row: int, size: int) -> np.ndarray:
    """Which units of a text the ranges in ``row`` of a list column cover."""
    mask = np.zeros(size + 1, dtype=np.int64)
    value = lists[row].values
    if value is not None and len(value):
        np.add.at(mask, value.field("lo").to_numpy(), 1)
        np.add.at(mask, value.field("hi").to_numpy(), -1)
    return np.cumsum(mask[:-1]) > 0


COVER = "ARRAY<STRUCT<lo: INT, hi: INT>>"
# ``place`` packs a run's first window, number of further windows, and whether its span repeats in its block;
# ``at`` is the anchor's place in the span.
RUN_SCHEMA = "a BIGINT, s BIGINT, key BIGINT, doc BIGINT, place BIGINT, at INT, cover " + COVER


def _run_rows(spec: Repeats) -> Callable:
    """Step 1: runs of all texts of a block, and what is covered within the block."""
    n, k = spec.size, spec.anchor

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, BLOCK_BYTES):
            yield from settle(block)

    def settle(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = list(text_bytes(batch.column("text")))
        keys, docs = batch.column("_key").to_numpy(), batch.column("_doc").to_numpy()
        parts = []
        for first_text, last_text in chunks(texts):
            data, start, end, first = spec.buffer(texts[first_text:last_text])
            units = len(data) if start is None else len(start)
            if units < n:
                continue
            piece = Hasher(data, 0)
            i = np.arange(units - k + 1)
            pieces = piece(i, i + k) if start is None else piece(start[:units - k + 1], end[k - 1:])
            text, anchor, low, high = runs(pieces, first, n, k)
            span = Hasher(data, 1)
            s = span(low, high + n) if start is None else span(start[low], end[high + n - 1])
            base = first[text]
            parts.append((pieces[anchor], s, text + first_text, low - base, high - base, (anchor - low).astype(np.int32)))
        if not parts:
            return
        a, s, text, low, high, at = (np.concatenate(p) for p in zip(*parts))
        doc = docs[text]
        order = np.lexsort((low, text, doc, s, a))
        a, s, text, low, high, at, doc = (x[order] for x in (a, s, text, low, high, at, doc))
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (s[1:] != s[:-1]))) if len(a) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        begins = np.flatnonzero(new)
        if spec.earlier:
            covered = doc > doc[begins][group]
            ship, many = ~covered, np.zeros(len(a), dtype=bool)
        else:
            many = np.bincount(group)[group] > 1 if len(a) else new
            covered, ship = many, new
        cover_text, cover = cover_lists(text[covered], low[covered], high[covered] + n)
        ship = np.flatnonzero(ship)
        n_cover = len(cover)
        own_keys = keys[cover_text]
        place = (low[ship] << 17) | ((high[ship] - low[ship]) << 1) | many[ship]

        def both(shipped, passed):
            return pa.array(np.concatenate((shipped, passed)))

        yield pa.RecordBatch.from_arrays([
            both(a[ship].view(np.int64), own_keys), both(s[ship].view(np.int64), own_keys),
            both(keys[text[ship]], own_keys), both(doc[ship], own_keys),
            both(place, np.zeros(n_cover, dtype=np.int64)), both(at[ship], np.zeros(n_cover, dtype=np.int32)),
            pa.concat_arrays([pa.nulls(len(ship), cover.type), cover]),
        ], names=["a", "s", "key", "doc", "place", "at", "cover"])

    return emit


def _edge_rows(spec: Repeats) -> Callable:
    """Step 3: the bytes of spans whose anchor has several."""
    n = spec.size

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {c: [] for c in ("a", "lead", "key", "doc", "lo", "at", "open", "span")}
            for text, key, doc, edges in zip(text_bytes(batch.column("text")), batch.column("_key").to_pylist(),
                                             batch.column("_doc").to_pylist(), batch.column("edges").to_pylist()):
                data, start, end, _ = spec.buffer([text])
                whole = data.tobytes()
                for e in edges:
                    low, high = e["lo"], e["hi"] + n - 1
                    span = whole[low:high + 1] if start is None else whole[start[low]:end[high]]
                    # Equal anchors have equal bytes here, whatever text the span has before them.
                    lead = span[e["at"]:e["at"] + min(8, spec.anchor)] if spec.lead else b""
                    for c, v in (("a", e["a"]), ("lead", lead), ("key", key), ("doc", doc), ("lo", low),
                                 ("at", e["at"]), ("open", e["open"]), ("span", span)):
                        rows[c].append(v)
            types = dict(a=pa.int64(), lead=pa.binary(), key=pa.int64(), doc=pa.int64(), lo=pa.int32(), at=pa.int32(),
                         open=pa.bool_(), span=pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(rows[c], types[c]) for c in types], names=list(types))

    return emit


EDGE_SCHEMA = "a BIGINT, lead BINARY, key BIGINT, doc BIGINT, lo INT, at INT, open BOOLEAN, span BINARY"


WINDOW_SCHEMA = "h0 BIGINT, h1 BIGINT, key BIGINT, doc BIGINT, open BOOLEAN, lo INT"


def _windows(spec: Repeats, spans: list[bytes]) -> tuple[np.ndarray, ...]:
    """All windows of spans: which span, place in it, and two hashes."""
    n = spec.size
    data, start, end, first = spec.buffer(spans)
    counts = np.diff(first) - n + 1
    which = np.repeat(np.arange(len(spans)), counts)
    place = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    low = first[which] + place
    begin, stop = (low, low + n) if start is None else (start[low], end[low + n - 1])
    return which, place, Hasher(data, 0)(begin, stop), Hasher(data, 1)(begin, stop)


def numbered(*columns: np.ndarray) -> np.ndarray:
    """Numbers of equal rows, in the order of the columns."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=bool)
    for column in columns:
        new[1:] |= column[order][1:] != column[order][:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def shared(*columns: np.ndarray) -> np.ndarray:
    """The same, with -1 for a row that has no equal."""
    group = numbered(*columns)
    return np.where(np.bincount(group)[group] > 1, group, -1) if len(group) else group


def extend(seed: np.ndarray, place: np.ndarray, room: np.ndarray, units: np.ndarray, step: int, most: int) -> list[np.ndarray]:
    """Sort spans by the units that follow ``place`` in steps of ``step``, as far as two of them agree.

    Entry ``j`` numbers the spans by their seed and ``j`` units, in order; -1
    marks those that end before (``room`` units) or agree with no other.
    """
    reach, known = [seed], seed
    rows = np.flatnonzero(seed >= 0)
    # Numbers in one integer: spans and units of a batch are far below 2^31.
    wide = int(units.max()) + 1 if len(units) else 1
    for j in range(most):
        rows = rows[room[rows] > j]
        if not len(rows):
            break
        own = shared(known[rows] * wide + units[place[rows] + step * j])
        known = np.full(len(seed), -1, dtype=np.int64)
        known[rows] = own
        rows = rows[own >= 0]
        reach.append(known)
    return reach


def matches(spec: Repeats, spans: list[bytes], anchor: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Windows that two or more spans share: spans, their first units, and numbers of equal windows."""
    n, k = spec.size, spec.anchor
    data, start, end, first = spec.buffer(spans)
    zero = first[:-1] + at
    hashed = Hasher(data, 1)
    if start is None:
        units, second = data.astype(np.int64), hashed(zero, zero + k)
    else:
        units = numbered(Hasher(data, 0)(start, end), hashed(start, end))
        second = hashed(start[zero], end[zero + k - 1])
    seed = shared(anchor, second)
    right = extend(seed, zero + k, np.diff(first) - at - k, units, 1, n - k)
    left = extend(seed, zero - 1, at, units, -1, n - k)
    for before in range(max(0, n - k + 1 - len(right)), len(left)):
        ahead, behind = right[n - k - before], left[before]
        rows = np.flatnonzero((ahead >= 0) & (behind >= 0))
        same = shared(behind[rows], ahead[rows])
        yield rows[same >= 0], at[rows[same >= 0]] - before, same[same >= 0]


def _compare(spec: Repeats) -> Callable:
    """Extend the matches of spans that come sorted by anchor."""

    def settle(table: pa.Table) -> pa.RecordBatch:
        spans = [v.as_py() for v in table.column("span")]
        keys, lows, docs, anchor, at = (table.column(c).to_numpy() for c in ("key", "lo", "doc", "a", "at"))
        opened = table.column("open").to_numpy(zero_copy_only=False)
        found = [(np.zeros(0, dtype=np.int64),) * 2]
        for rows, place, same in matches(spec, spans, anchor, at.astype(np.int64)):
            covered = opened[rows]
            if spec.earlier and len(rows):
                least = np.full(same.max() + 1, NO_ID)
                np.minimum.at(least, same, docs[rows])
                covered = covered & (docs[rows] > least[same])
            found.append((rows[covered], lows[rows[covered]] + place[covered]))
        rows, low = (np.concatenate(x) for x in zip(*found))
        spans_covered, cover = cover_lists(rows, low, low + spec.size)
        return pa.RecordBatch.from_arrays([pa.array(keys[spans_covered]), cover], names=["key", "cover"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= 8192:
                # The last anchor may go on in the next batch.
                table = pa.Table.from_batches(held)
                a = table.column("a").to_numpy()
                cut = int(np.searchsorted(a, a[-1]))
                if cut:
                    yield settle(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                size = table.num_rows - cut
        if size:
            yield settle(pa.Table.from_batches(held))

    return compare


def _wide_rows(spec: Repeats) -> Callable:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                which, place, h0, h1 = _windows(spec, [v.as_py() for v in batch.column("span")])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h0.view(np.int64)), pa.array(h1.view(np.int64)), *(batch.column(c).take(pa.array(which)) for c in ("key", "doc", "open")),
                     pa.array((batch.column("lo").to_numpy()[which] + place).astype(np.int32))],
                    names=["h0", "h1", "key", "doc", "open", "lo"])

    return emit


def keyed(docs: DataFrame, earlier: bool) -> DataFrame:
    """``docs`` with ``_key``, which tells texts apart, and ``_doc``, the id that orders them."""
    if earlier and not isinstance(docs.schema["doc_id"].dataType, (T.IntegralType, T.NullType)):
        raise TypeError("doc_id must be a whole number, since it orders the documents")
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) if earlier else F.lit(0).cast("long")
    return docs.withColumns({"_key": F.xxhash64("doc_id", "text"), "_doc": order})


def covered_ranges(docs: DataFrame, spec: Repeats) -> DataFrame:
    """``(key, covers)`` of all texts with covered units, for rows of :func:`keyed`.

    ``covers`` lists ranges ``[lo, hi)`` of units, which may overlap.  Texts
    move to their edges by the same exchange that moves them to their ranges.
    """
    found = map_texts(docs.select("_key", "_doc", "text"), _run_rows(spec), RUN_SCHEMA).repartition("a")
    span, anchor = Window.partitionBy("a", "s"), Window.partitionBy("a")
    many = F.max(F.col("place").bitwiseAND(1)).over(span) == 1
    covered = F.col("doc") > F.min("doc").over(span) if spec.earlier else (F.count("*").over(span) > 1) | many
    ranked = found.withColumns({
        "rank": F.row_number().over(span.orderBy("key", "place")), "covered": covered,
    }).withColumn("spans", F.sum((F.col("rank") == 1).cast("int")).over(anchor))
    edge = (F.col("spans") > 1) & (~F.col("covered") if spec.earlier else ~F.col("covered") | (F.col("rank") == 1)) & F.col("cover").isNull()
    low = F.shiftright("place", 17).cast("int")
    high = low + F.shiftright("place", 1).bitwiseAND(0xFFFF).cast("int")
    settled = ranked.filter(F.col("cover").isNotNull() | F.col("covered") | edge).select(
        "key", "cover", "covered", edge.alias("edge"),
        F.struct("a", "at", low.alias("lo"), high.alias("hi"), (~F.col("covered")).alias("open"),
                 (F.col("spans") > spec.wide).alias("wide")).alias("run"))
    by_text = settled.groupBy("key").agg(
        F.flatten(F.collect_list("cover")).alias("inner"),
        F.collect_list(F.when(F.col("covered") & F.col("cover").isNull(), F.struct(
            "run.lo", (F.col("run.hi") + spec.size).alias("hi")))).alias("whole"),
        F.collect_list(F.when(F.col("edge"), F.col("run"))).alias("edges"))
    ranges = staged(by_text.select("key", F.concat("inner", "whole").alias("covers"), "edges"), "ranges")

    def edges(which: str, emit: Callable, schema: str) -> DataFrame:
        chosen = ranges.select("key", F.filter("edges", lambda e: e["wide"] if which == "wide" else ~e["wide"]).alias("edges"))
        own = docs.join(chosen.filter(F.size("edges") > 0), F.col("_key") == F.col("key"))
        return map_texts(own, emit, schema)

    spans = _edge_rows(spec)
    near = edges("near", spans, EDGE_SCHEMA)
    near = near.repartitionByRange("lead", "a") if spec.lead else near.repartition("a")
    near = near.sortWithinPartitions("a").mapInArrow(_compare(spec), "key BIGINT, cover " + COVER)
    windows = _wide_rows(spec)
    rows = edges("wide", lambda batches: windows(spans(batches)), WINDOW_SCHEMA)
    sums = rows.groupBy("h0", "h1").agg(F.min("doc").alias("least"), F.count("*").alias("n"))
    wide = rows.join(sums, ["h0", "h1"]).filter("open AND " + ("doc > least" if spec.earlier else "n > 1")).select(
        "key", F.array(F.struct("lo", (F.col("lo") + spec.size).alias("hi"))).alias("cover"))
    compared = near.union(wide).groupBy("key").agg(F.flatten(F.collect_list("cover")).alias("covers"))
    return ranges.select("key", "covers").union(compared).groupBy("key").agg(F.flatten(F.collect_list("covers")).alias("covers"))
