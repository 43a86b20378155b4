"""Token ids in files: one wavelet matrix a shard.

``write_token_files`` encodes texts where they lie, deals them by ascending
document id into shards and writes each shard as one compressed Parquet file:
the shard's different ids, the bit-planes of its wavelet matrix and the place
of each document.  ``read_token_files`` numbers the shards' first tokens, and
``document_tokens``, ``token_at``, ``count_token`` and ``find_token`` answer from
the files alone, by rank and select.

Encoding meets each different word of a task once: a tokenizer that drops white
space (``words=True``) gives a text the ids of its words, one after another.
Words go through the library's own normalizer, pre-tokenizer and model; a word
with the opening of a special token goes through the whole tokenizer.  With
``words=False`` texts are encoded whole.

Ranges of ids are cut at a bounded sample (200 rows a range); the sample decides
only where shards end.  A range's task holds one shard at a time, so an id, or
an equal text, that makes up a third of all rows is cut like any other.

NULL and empty texts have the end id alone; rows whose ids repeat stand beside
each other in the order of their texts' hashes; NULL ids come last; other
columns are not read; an empty table gives no file rows.
"""

from __future__ import annotations

import bisect
import os
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from larkspur.llm.common import blocks, map_texts, mix64
from larkspur.llm.wavelet import WaveletMatrix

# Words that an encoder remembers before it starts anew.
REMEMBERED = 400_000
# Sampled rows for each range; tokens of one stretch, in which places meet shards.
SAMPLED, SPREAD = 200, 1 << 24


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of texts, each different word encoded once."""

    def __init__(self, definition: str, words: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.words, self.model, self.stops = words, self.tokenizer.model, {}
        if words:
            # Letters that stay one piece within a word, and what the model sees of them.
            seen = {c: self._pieces(f"a{c}a") for c in map(chr, range(0x180)) if c.isalpha()}
            self.letters = {ord(c): p[0][1:-1] for c, p in seen.items() if len(p) == 1}
            self.plain = re.compile("([" + "".join(map(chr, self.letters)) + "]+)([,.])?")
        self.start_anew()

    def start_anew(self) -> None:
        self.slots, self.flat, self.ends = {}, array("I"), array("q", [0])

    def _pieces(self, text: str) -> list[str]:
        return [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))]

    def _ids(self, word: str) -> list[int]:
        """Ids of a word; a closing comma or stop behind plain letters is a piece of its own."""
        if found := self.plain.fullmatch(word):
            core, stop = found.groups()
            ids = [t.id for t in self.model.tokenize(core.translate(self.letters))]
            return ids if stop is None else ids + self._stop(stop)
        if "<" in word:
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        return [t.id for piece in self._pieces(word) for t in self.model.tokenize(piece)]

    def _stop(self, stop: str) -> list[int]:
        if stop not in self.stops:
            self.stops[stop] = self._ids(stop)
        return self.stops[stop]

    def _slots(self, words: list[str]) -> np.ndarray:
        """Where the ids of each of these different words stand; words not met before are encoded."""
        slots = [*map(self.slots.get, words)]
        for place, slot in enumerate(slots):
            if slot is None:
                word = words[place]
                slots[place] = self.slots[word] = len(self.ends) - 1
                self.flat.extend(self._ids(word))
                self.ends.append(len(self.flat))
        return np.array(slots, dtype=np.int64)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin, with the end of all."""
        texts = pc.fill_null(texts, "")
        if not self.words:
            found = [e.ids for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            first = np.concatenate(([0], np.cumsum([len(f) for f in found], dtype=np.int64)))
            return np.array([i for f in found for i in f], dtype=np.uint32), first
        split = pc.ascii_split_whitespace(texts)
        named = split.flatten().dictionary_encode()
        if len(self.slots) > REMEMBERED:
            self.start_anew()
        slots = self._slots(named.dictionary.to_pylist())
        ends = np.frombuffer(self.ends, dtype=np.int64)
        begin, sizes = ends[slots], (ends[slots + 1] - ends[slots]).astype(np.int32)
        own = named.indices.to_numpy()
        sizes = sizes[own]
        total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        flat = np.frombuffer(self.flat, dtype=np.uint32) if len(self.flat) else np.zeros(0, dtype=np.uint32)
        # Places of ids in ``flat``: half the bytes unless a text is enormous.
        kind = np.int32 if max(total[-1], len(flat)) < 1 << 31 else np.int64
        places = np.repeat((begin[own] - total[:-1]).astype(kind), sizes)
        places += np.arange(total[-1], dtype=kind)
        ids = flat[places]
        del ends, flat
        return ids, total[split.offsets.to_numpy() - split.offsets[0].as_py()]


def _encoder(definition: str, words: bool) -> Encoder:
    """The encoder of this Python worker, which its later tasks find again."""
    kept = sys.modules.setdefault("_larkspur_encoders", types.ModuleType("_larkspur_encoders")).__dict__
    key = f"{zlib.crc32(definition.encode())}-{len(definition)}-{words}"
    if key not in kept:
        kept[key] = Encoder(definition, words)
    return kept[key]


def _unit(numbers: np.ndarray) -> np.ndarray:
    return (mix64(numbers.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.int64)


def _cuts(docs: DataFrame, n: int, rows: int) -> list[tuple]:
    """Keys at which ``n`` ranges of ids are cut, from a bounded sample."""
    if n < 2 or not rows:
        return []
    tie = F.xxhash64("text")
    sample = docs.select(F.col("doc_id").isNull(), "doc_id", tie, (F.rand(7) * (1 << 53)).cast("long")).sample(
        min(1.0, SAMPLED * n / rows), seed=11)
    # NULL ids tell themselves apart by the first column; the second then only has to compare.
    found = sorted((tuple(r) for r in sample.collect()), key=_order)
    return [_order(found[len(found) * i // n]) for i in range(1, n)] if found else []


def _order(key: tuple) -> tuple:
    none, doc_id, tie, unit = key
    return none, (tie if none else doc_id), tie, unit


FILES = "shard_range INT, piece INT, n_tokens BIGINT, doc_ids ARRAY<{id}>, sizes ARRAY<BIGINT>, ids BINARY, planes BINARY"


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int | None = 1, words: bool = True,
                      shard_tokens: int = 1 << 24, range_bytes: int = 32 << 20, most_ranges: int = 20_000) -> None:
    """Encode ``docs`` (``doc_id``, ``text``) and write a file for each shard under ``path``.

    ``tokenizer`` is the path of a definition of the tokenizers library, read
    by the driver.  ``end_id`` closes each document (None: nothing does).  A
    shard holds whole documents and is closed at ``shard_tokens``; a document
    beyond it is a shard itself.  ``most_ranges`` bounds the number of tasks,
    not what they write.
    """
    with open(tokenizer or tokenizer_path(), encoding="utf-8") as file:
        definition = file.read()
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n = int(min(most_ranges, max(1, -(-(size["bytes"] or 0) // range_bytes))))
    cuts = _cuts(docs, n, size["rows"])
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = _encoder(definition, words), TaskContext.get().partitionId() << 40
        for block in blocks(batches, 8 << 20):
            ids, first = encoder(block.column("text"))
            if end_id is not None:
                ids, first = np.insert(ids, first[1:], end_id), first + np.arange(len(first))
            ties = block.column("tie").to_pylist()
            units = _unit(seen + np.arange(block.num_rows)).tolist()
            seen += block.num_rows
            doc_ids = block.column("doc_id")
            ranges = [bisect.bisect_right(cuts, _order((d is None, d, t, u))) for d, t, u in zip(doc_ids.to_pylist(), ties, units)]
            small = ids.astype("<u2") if not len(ids) or ids.max() < 1 << 16 else ids.astype("<u4")
            width = small.dtype.itemsize
            tokens = pa.Array.from_buffers(pa.binary(), block.num_rows, [
                None, pa.py_buffer((width * first).astype(np.int32).tobytes()), pa.py_buffer(small.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges, pa.int32()), doc_ids, block.column("tie"), pa.array(units, pa.int64()),
                 pa.array(np.full(block.num_rows, width, dtype=np.int32)), tokens],
                names=["shard_range", "doc_id", "tie", "unit", "width", "tokens"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, piece, current, types = 0, 0, None, None

        def shard() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.concatenate([t for _, t in held]))
            ids, planes = matrix.to_bytes()
            columns = [[current], [piece], [matrix.size], [[d for d, _ in held]], [[len(t) for _, t in held]], [ids], [planes]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(types), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=["shard_range", "piece", "n_tokens", "doc_ids", "sizes", "ids", "planes"])

        for batch in batches:
            types = batch.schema.field("doc_id").type
            for number, doc_id, width, data in zip(*(batch.column(c).to_pylist() for c in ("shard_range", "doc_id", "width", "tokens"))):
                tokens = np.frombuffer(data, dtype=f"<u{width}")
                if held and (number != current or size + len(tokens) > shard_tokens):
                    yield shard()
                    piece = piece + 1 if number == current else 0
                    held, size = [], 0
                current = number
                held.append((doc_id, tokens))
                size += len(tokens)
        if held:
            yield shard()

    encoded = map_texts(docs.withColumn("tie", F.xxhash64("text")), encode,
                        f"shard_range INT, doc_id {id_type}, tie BIGINT, unit BIGINT, width INT, tokens BINARY")
    dealt = encoded.repartitionById(n, F.col("shard_range")).sortWithinPartitions(
        "shard_range", F.col("doc_id").asc_nulls_last(), "tie", "unit")
    files = map_texts(dealt, build, FILES.format(id=id_type))
    files.write.option("compression", "zstd").option("maxRecordsPerFile", 1).parquet(path)


def read_token_files(spark: SparkSession, path: str, shards_per_group: int = 1000, most_broadcast: int = 200_000) -> DataFrame:
    """The shards, with ``start``: the number of tokens before each in id order.

    The starts of up to ``most_broadcast`` shards (24 bytes each) go to the
    shards; beyond that both sides of the join are shuffled.
    """
    files = spark.read.parquet(path)
    group = F.floor(F.col("shard_range") / F.lit(shards_per_group)).cast("int")
    sizes = files.select("shard_range", "piece", "n_tokens", group.alias("group"))
    # One row for each group of ranges reaches the driver.
    totals = sorted(tuple(r) for r in sizes.groupBy("group").agg(F.sum("n_tokens"), F.count("*")).collect())
    begins = np.cumsum([0] + [n for _, n, _ in totals]).tolist()
    firsts = spark.createDataFrame([(g, b) for (g, _, _), b in zip(totals, begins)], "group INT, before BIGINT")
    within = Window.partitionBy("group").orderBy("shard_range", "piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(F.broadcast(firsts), "group").select(
        "shard_range", "piece", (F.col("before") + F.col("inside")).alias("start"))
    few = sum(count for _, _, count in totals) <= most_broadcast
    return files.join(F.broadcast(starts) if few else starts, ["shard_range", "piece"])


def _matrix(row: dict) -> WaveletMatrix:
    return WaveletMatrix.from_bytes(row["ids"], row["planes"], row["n_tokens"])


def _each_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _id_type(shards: DataFrame) -> str:
    return shards.schema["doc_ids"].dataType.elementType.simpleString()


def document_tokens(shards: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, tokens)`` of every document; tokens are little-endian unsigned 32-bit numbers."""
    kind = shards.schema["doc_ids"].dataType.elementType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        for row in _each_shard(batches):
            tokens = _matrix(row).tokens()
            sizes = np.array(row["sizes"], dtype=np.int64)
            first = np.concatenate(([0], np.cumsum(sizes)))
            # Some 2^23 bytes a batch.
            cuts = np.unique(np.append(np.searchsorted(first, np.arange(0, first[-1] + 1, 1 << 21)), len(sizes)))
            for low, high in zip(cuts[:-1], cuts[1:]):
                part = first[low:high + 1]
                data = pa.Array.from_buffers(pa.large_binary(), high - low, [
                    None, pa.py_buffer((4 * (part - part[0])).astype(np.int64).tobytes()),
                    pa.py_buffer(tokens[part[0]:part[-1]].astype("<u4").tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"][low:high], to_arrow_type(kind)), pa.array(row["start"] + part[:-1]), pa.array(sizes[low:high]),
                     data.cast(pa.binary())], names=["doc_id", "start", "n_tokens", "tokens"])

    return map_texts(shards, read, f"doc_id {_id_type(shards)}, start BIGINT, n_tokens BIGINT, tokens BINARY")


def document_checksums(shards: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document: ids as little-endian unsigned 32-bit numbers."""

    kind = shards.schema["doc_ids"].dataType.elementType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        for row in _each_shard(batches):
            data = memoryview(_matrix(row).tokens().astype("<u4", copy=False)).cast("B")
            sizes = np.array(row["sizes"], dtype=np.int64)
            first = np.concatenate(([0], np.cumsum(sizes)))
            sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], to_arrow_type(kind)), pa.array(row["start"] + first[:-1]), pa.array(sizes), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_texts(shards, read, f"doc_id {_id_type(shards)}, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")


def token_at(shards: DataFrame, places: DataFrame, place: str = "place") -> DataFrame:
    """``(place, token)`` for numbers of tokens in id order; places outside have no row.

    Places and shards meet by the stretches of ``SPREAD`` tokens that they lie
    in; each shard answers its own by walking down the planes.
    """
    at = F.col(f"`{place}`").cast("long").alias("place")
    asked = places.select(at).filter(F.col("place") >= 0).distinct().withColumn("stretch", F.floor(F.col("place") / F.lit(SPREAD)))
    last = F.col("start") + F.col("n_tokens") - 1
    spans = shards.filter("n_tokens > 0").select("shard_range", "piece", "start", "n_tokens", F.explode(F.sequence(
        F.floor(F.col("start") / F.lit(SPREAD)), F.floor(last / F.lit(SPREAD)))).alias("stretch"))
    owned = asked.join(spans, "stretch").filter((F.col("place") >= F.col("start")) & (F.col("place") <= last)).select(
        F.col("shard_range").alias("of_range"), F.col("piece").alias("of_piece"), "place")

    def answer(key: tuple, wanted: pa.Table, held: pa.Table) -> pa.Table:
        wanted = wanted.column("place").to_numpy()
        if not len(wanted):
            return pa.table({"place": pa.array([], pa.int64()), "token": pa.array([], pa.int64())})
        row = next(_each_shard(held.to_batches()))
        tokens = _matrix(row).access(wanted - row["start"])
        return pa.table({"place": pa.array(wanted), "token": pa.array(tokens.astype(np.int64))})

    return owned.groupBy("of_range", "of_piece").cogroup(shards.groupBy("shard_range", "piece")).applyInArrow(
        answer, "place BIGINT, token BIGINT")


def count_token(shards: DataFrame, token: int) -> DataFrame:
    """``(doc_id, n)`` of every document that holds ``token``: one rank at each end of a document."""
    kind = shards.schema["doc_ids"].dataType.elementType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        for row in _each_shard(batches):
            ends = np.cumsum(row["sizes"], dtype=np.int64)
            n = _matrix(row).count(token, ends - np.array(row["sizes"], dtype=np.int64), ends)
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([row["doc_ids"][i] for i in some], to_arrow_type(kind)), pa.array(n[some])],
                                             names=["doc_id", "n"])

    return map_texts(shards, count, f"doc_id {_id_type(shards)}, n BIGINT")


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """``(doc_id, offset, place)`` of every occurrence of ``token``: its offset in the document and its number in id order."""
    kind = shards.schema["doc_ids"].dataType.elementType

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        for row in _each_shard(batches):
            matrix, ends = _matrix(row), np.cumsum(row["sizes"], dtype=np.int64)
            n = int(matrix.count(token, [0], [matrix.size])[0])
            for low in range(0, n, 1 << 18):
                places = matrix.occurrences(token, low, min(n, low + (1 << 18)))
                owner = np.searchsorted(ends, places, side="right")
                begins = ends - np.array(row["sizes"], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_ids"][i] for i in owner], to_arrow_type(kind)), pa.array(places - begins[owner]),
                     pa.array(row["start"] + places)], names=["doc_id", "offset", "place"])

    return map_texts(shards, find, f"doc_id {_id_type(shards)}, offset BIGINT, place BIGINT")
