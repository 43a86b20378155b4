"""Benchmark decontamination with a generalised suffix automaton.

The automaton of all benchmark items, over normalised words, is built once
and sent to the tasks.  Each task streams the words of its documents through
it and keeps the length of the longest match that ends at each word; where
that length reaches the window, the words of the window are hit.  There is no
shuffle, so no key can be hot.

Spark counts the benchmark's words first.  A larger benchmark is cut into parts
of at most ``words_per_automaton`` words, an item beyond that into pieces that
overlap by a window less one word.  Automata are sent together, and pass the
documents together, as long as their measured memory stays within
``pass_bytes`` (a Python worker takes up to twice that while it loads them, and
the driver some 0.2 GB more while it builds one of a million words).  Beyond it
there are several passes: the hits of each are written and its automata dropped
before the next, and hits of all passes then meet by row.

Texts are lower-cased in A-Z; words are runs of ASCII letters and digits and
of all characters beyond ASCII.  A NULL or empty text has no words and is not
contaminated; an item without words matches nothing; equal items count as
separate items; an empty benchmark leaves every document as it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from larkspur.llm.automaton import Automaton
from larkspur.llm.common import map_texts, staged, text_bytes, without

TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")
REPORT = ("n_words", "n_hit", "hit_items", "hit_spans")
INNER = ("_leak_row", "_leak_hit_spans", "_leak_hit_items")


def words_of(text: bytes) -> list[bytes]:
    """Normalised words of a UTF-8 text."""
    return TOKEN.findall(text.lower())


# A word of a text that is not yet lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def parts_of(benchmark: DataFrame, window: int, words_per_automaton: int) -> DataFrame:
    """``(task, part, item_id, words)``: pieces of items, in parts of at most so many words (or one window) each.

    A part is named by the task that packed it and its number there.
    """
    limit = max(window, words_per_automaton)
    schema = T.StructType([T.StructField("task", T.IntegerType()), T.StructField("part", T.IntegerType()),
                           benchmark.schema["item_id"], T.StructField("words", T.BinaryType())])
    types = [pa.int32(), pa.int32(), None, pa.binary()]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, part, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            places, numbers, pieces = [], [], []
            for place, text in enumerate(text_bytes(batch.column("text"))):
                words = words_of(text)
                # Pieces start where windows are left, so each window is whole in one of them.
                for start in range(0, max(1, len(words) - window + 1) if words else 0, limit - window + 1):
                    piece = words[start:start + limit]
                    if total and total + len(piece) > limit:
                        part, total = part + 1, 0
                    total += len(piece)
                    places.append(place)
                    numbers.append(part)
                    pieces.append(b" ".join(piece))
            columns = [[task] * len(places), numbers, batch.column("item_id").take(pa.array(places, pa.int64())), pieces]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) if t else c for c, t in zip(columns, types)], names=schema.names)

    items = benchmark.select("item_id", "text")
    total = items.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0
    tasks = -(-total // limit)
    return staged(map_texts(items.repartition(tasks) if tasks > 1 else items.coalesce(1), pack, schema), "benchmark-parts")


def automata(parts: DataFrame, window: int, pass_bytes: int) -> Iterator[tuple[list[Automaton], bool]]:
    """Automata of the parts, those of one pass together, and whether they are the last.

    A pass is full when one more automaton like its largest would not fit; one
    that exceeds the bound by itself is a pass of its own.  Without any words
    there is one automaton that matches nothing.
    """
    names = parts.select("task", "part").distinct().orderBy("task", "part").collect()
    held, sizes = [], []
    for place, (task, part) in enumerate(names, 1):
        rows = parts.filter((F.col("task") == task) & (F.col("part") == part)).collect()
        held.append(Automaton([(r["item_id"], bytes(r["words"]).split(b" ")) for r in rows], window))
        sizes.append(held[-1].n_bytes())
        if place == len(names) or sum(sizes) + max(sizes) > pass_bytes:
            yield held, place == len(names)
            held, sizes = [], []
    if not names:
        yield [Automaton([], window)], True


def _merge(spans: list[list[int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    return merged


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10,
              words_per_automaton: int = 1_000_000, pass_bytes: int = 256 << 20) -> DataFrame:
    """Documents with ``n_words``, ``n_hit``, ``hit_items`` and ``hit_spans``.

    ``hit_spans`` are maximal runs ``[start, end)`` of hit words; ``hit_items``
    are sorted.  Columns of ``docs`` with these names are replaced.
    """
    base, result = _prepared(docs, benchmark.schema["item_id"].dataType)
    found, step = _found(result, benchmark, window, words_per_automaton, pass_bytes)
    return map_texts(found, step, result.schema).withColumn(
        "n_hit", F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]))).select(*base.columns, *REPORT)


def _prepared(docs: DataFrame, item_type: T.DataType) -> tuple[DataFrame, DataFrame]:
    """``docs`` without columns of the report's names, and with empty columns for what scanning finds."""
    base = without(docs, [*REPORT, *INNER])
    span = T.ArrayType(T.ArrayType(T.IntegerType()))
    return base, base.withColumns({"n_words": F.lit(None).cast("long"), "hit_spans": F.lit(None).cast(span),
                                   "hit_items": F.lit(None).cast(T.ArrayType(item_type))})


def _found(result: DataFrame, benchmark: DataFrame, window: int, words_per_automaton: int, pass_bytes: int) -> tuple:
    """Documents, and the last step that completes their report.

    With one pass that step scans them.  With more, each pass's hits are
    written before the next is sent, and the step joins those of a document.
    """
    context = result.sparkSession.sparkContext
    fields = [f for f in result.schema.fields if f.name in ("hit_spans", "hit_items")]
    hit_schema = T.StructType([T.StructField("_leak_row", T.LongType()), *fields])
    numbered = hits = None
    for held, last in automata(parts_of(benchmark, window, words_per_automaton), window, pass_bytes):
        shared = context.broadcast(held)
        if last and hits is None:
            return result, _scanner(shared)
        if hits is None:
            # The row's number is written, so that every pass and the join read the same one.
            numbered = staged(result.withColumn("_leak_row", F.monotonically_increasing_id()), "numbered")
        texts = numbered.select("_leak_row", "text", "n_words", "hit_spans", "hit_items")
        own = staged(map_texts(texts, _chained([_scanner(shared), _only_hits]), hit_schema), "hits")
        shared.destroy()
        hits = own if hits is None else hits.union(own)
    joined = hits.groupBy("_leak_row").agg(*(F.flatten(F.collect_list(c)).alias(f"_leak_{c}") for c in ("hit_spans", "hit_items")))
    columns = {c: F.col(f"_leak_{c}") for c in ("hit_spans", "hit_items")}
    return numbered.join(joined, "_leak_row", "left").select(
        *[columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in result.columns]), _scanner(None)


def _only_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        some = pa.array([bool(spans) for spans in batch.column("hit_spans").to_pylist()], pa.bool_())
        yield batch.select(["_leak_row", "hit_spans", "hit_items"]).filter(some)


def _chained(steps: list):
    """One function for all steps, so that a task needs one Python worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps:
            batches = step(batches)
        return batches

    return run


def _scanner(shared):
    """Scan texts by the automata of a pass; without any, join what is known of them."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = shared.value if shared else []
        for batch in batches:
            counts, all_spans, all_items = [], [], []
            known = zip(batch.column("hit_spans").to_pylist(), batch.column("hit_items").to_pylist())
            for text, (spans, items) in zip(text_bytes(batch.column("text")), known):
                words = words_of(text)
                spans, hit = spans or [], set(items or ())
                for automaton in passing:
                    more, keys = automaton.scan(words)
                    spans += more
                    hit |= keys
                counts.append(len(words))
                all_spans.append(_merge(spans))
                all_items.append(sorted(hit, key=lambda x: (x is not None, x)))
            new = {"n_words": counts, "hit_spans": all_spans, "hit_items": all_items}
            yield pa.RecordBatch.from_arrays(
                [pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name) for f in batch.schema],
                schema=batch.schema)

    return scan


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5,
                  words_per_automaton: int = 1_000_000, pass_bytes: int = 256 << 20) -> DataFrame:
    """Documents without their hit spans; those hit beyond a share of their words go.

    From the first to the last word of a span everything is cut out of
    ``text``; texts without hits stay byte for byte.
    """
    base, result = _prepared(docs, benchmark.schema["item_id"].dataType)
    schema = base.schema
    found, step = _found(result, benchmark, window, words_per_automaton, pass_bytes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept = [], []
            columns = (batch.column("text"), batch.column("hit_spans").to_pylist(), batch.column("n_words").to_pylist())
            for value, spans, n in zip(*columns):
                text = value.as_py()
                kept.append(sum(end - start for start, end in spans) <= max_coverage * n)
                if spans and kept[-1]:
                    raw = text.encode()
                    places = [m.span() for m in TOKEN.finditer(raw.lower())]
                    left, at = [], 0
                    for start, end in spans:
                        left.append(raw[at:places[start][0]])
                        at = places[end - 1][1]
                    text = b"".join([*left, raw[at:]]).decode()
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, batch.schema.field("text").type) if c == "text" else batch.column(c) for c in schema.names],
                names=schema.names).filter(pa.array(kept, pa.bool_()))

    return map_texts(found, _chained([step, cut]), schema)
