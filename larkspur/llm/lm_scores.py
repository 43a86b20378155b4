"""Language-model scoring with an Elias-Fano trie of bigrams, in shards.

The model is an interpolated bigram model: a context seen ``c1`` times gives
its successors ``c12 / (c1 + strength)``, and the rest by the smoothed unigram
model ``(c + 1) / (N + V + 1)``.  Nothing of it is ever in one place: the trie
grows with the corpus, so it is cut into shards by context (a context seen
more than ``SPLIT`` times, by parts of its successors as well), and each shard
is one task's work.

Documents are dealt into blocks of about ``block_bytes``.  A block asks for each
different word, then for each different bigram, once, in packed rows; a shard
adds up what all blocks counted, builds its levels in memory-mapped files
(contexts with monotone pointers, successors relative to their context,
quantised probabilities), looks each different bigram up once by successor
search between its context's pointers, and sends each block two bytes for each
of its bigrams.  Word and bigram counts cover every training
document; no list of words or bigrams reaches the driver.

Words are lower-cased in A-Z and known by 64-bit hashes; within the shards by
40 bits.  NULL and empty texts are one end token; repeated rows are scored (and
learned) each; a NULL id counts as a training document; without any training
document all counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.llm.anchors import Hasher, Words, chunks
from larkspur.llm.common import blocks, map_texts, mix64, staged, text_bytes
from larkspur.llm.elias_fano import EliasFano, Store

# The keys of the end of a text and of the place before its first word.
END, START = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)
SPLIT = 1 << 20
# Quantised probabilities: -log10 in steps of 1/4096; the last code means none.
STEP, NONE = 4096, 65535
KEY_BYTES = 5
# Bigrams that a shard looks up at a time.
LOOKED_UP = 1 << 19


def held_out(doc_id: Column) -> Column:
    """Ids whose CRC-32 (of the id as text) leaves 2 when divided by 7."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens, ends included, and where each text's begin."""
    keys, counts = [], []
    lowered = [t.lower() for t in texts]
    for low, high in chunks(lowered):
        words = Words(lowered[low:high])
        own = Hasher(words.data, 0)(words.start, words.end) if len(words.start) else np.zeros(0, dtype=np.uint64)
        keys.append(np.insert(own, words.first[1:], END))
        counts.append(np.diff(words.first) + 1)
    if not keys:
        return np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    return np.concatenate(keys), np.concatenate(([0], np.cumsum(np.concatenate(counts))))


def count_words(docs: DataFrame) -> DataFrame:
    """``(key, n)`` of all tokens of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, 8 << 20):
            keys, n = np.unique(tokens(list(text_bytes(block.column("text"))))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

    return map_texts(docs.select("text"), count, "key BIGINT, n BIGINT").groupBy("key").agg(F.sum("n").alias("n"))


class _Block:
    """Tokens of a block by its sorted different words; bigrams in the order of the shards."""

    def __init__(self, table: pa.Table, n_shards: int):
        self.n_shards = n_shards
        keys, self.first = tokens(list(text_bytes(table.column("text"))))
        self.words, self.word = np.unique(keys, return_inverse=True)
        # Words by shard, then by key.
        self.shard_of_word = self.words.view(np.int64) % n_shards
        self.word_order = np.lexsort((self.words, self.shard_of_word))

    def word_slices(self) -> Iterator[tuple[int, np.ndarray]]:
        cuts = np.searchsorted(self.shard_of_word[self.word_order], np.arange(self.n_shards + 1))
        for shard in range(self.n_shards):
            if cuts[shard] < cuts[shard + 1]:
                yield shard, self.word_order[cuts[shard]:cuts[shard + 1]]

    def take_counts(self, answers: pa.Table) -> None:
        given = _payloads(answers, 1)
        self.count = np.zeros(len(self.words), dtype=np.int64)
        for shard, places in self.word_slices():
            self.count[places] = np.frombuffer(given[shard], dtype="<i8")

    def bigrams(self) -> None:
        """Different bigrams, sorted by shard, context and successor."""
        n = len(self.words)
        context = np.empty(len(self.word), dtype=np.int64)
        context[1:] = self.word[:-1]
        context[self.first[:-1]] = n
        pairs, self.pair = np.unique(context * (n + 1) + self.word, return_inverse=True)
        self.pair_context, self.pair_word = pairs // (n + 1), pairs % (n + 1)
        end = np.searchsorted(self.words, END)
        self.context_count = np.append(self.count, self.count[end])
        shift = np.uint64(64 - 8 * KEY_BYTES)
        short = np.append(self.words, START) >> shift
        a, b = short[self.pair_context], short[self.pair_word]
        parts = (self.context_count[self.pair_context] // SPLIT + 1).astype(np.uint64)
        shard = (mix64(a * np.uint64(0x9E3779B97F4A7C15) + b % parts) % np.uint64(self.n_shards)).astype(np.int64)
        self.pair_order = np.lexsort((b, a, shard))
        self.a, self.b, self.shard = a[self.pair_order], b[self.pair_order], shard[self.pair_order]

    def pair_slices(self) -> Iterator[tuple[int, slice]]:
        cuts = np.searchsorted(self.shard, np.arange(self.n_shards + 1))
        for shard in range(self.n_shards):
            if cuts[shard] < cuts[shard + 1]:
                yield shard, slice(cuts[shard], cuts[shard + 1])


def _payloads(answers: pa.Table, kind: int) -> dict[int, bytes]:
    return {s: p for k, s, p in zip(*(answers.column(c).to_pylist() for c in ("kind", "shard", "payload"))) if k == kind}


def _short(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def _long(data: bytes) -> np.ndarray:
    short = np.frombuffer(data, dtype=np.uint8).reshape(-1, KEY_BYTES)
    full = np.zeros((len(short), 8), dtype=np.uint8)
    full[:, :KEY_BYTES] = short
    return full.view("<u8").ravel()


class Trie:
    """One shard: contexts with pointers, successors, quantised probabilities.

    Successors are stored relative to their context: each range that the
    pointers mark goes on above the last value of the range before it, so that
    the whole level is one rising sequence.
    """

    def __init__(self, contexts: np.ndarray, context_counts: np.ndarray, rank: np.ndarray, successors: np.ndarray,
                 counts: np.ndarray, strength: float, store: Store):
        """``contexts`` ascend; entries ascend by ``rank`` of their context, then by successor."""
        pointers = np.searchsorted(rank, np.arange(len(contexts) + 1))
        some = pointers[1:] > pointers[:-1]
        room = np.zeros(len(contexts) + 1, dtype=np.uint64)
        room[1:][some] = successors[pointers[1:][some] - 1] + np.uint64(1)
        self.contexts, self.pointers = EliasFano(contexts, store), EliasFano(pointers, store)
        self.successors = EliasFano(np.cumsum(room, dtype=np.uint64)[rank] + successors, store)
        share = counts / (context_counts[rank] + strength)
        codes = np.clip(np.rint(-np.log10(share) * STEP), 0, NONE - 1).astype("<u2")
        self.codes = store.put(codes)

    def look_up(self, contexts: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Codes of bigrams that ascend by context, then by successor; ``NONE`` for unseen ones.

        A context's two pointers give its range, the value before the range
        what its successors count from; only there is the successor searched.
        """
        fresh = np.ones(len(contexts), dtype=bool)
        fresh[1:] = contexts[1:] != contexts[:-1]
        asked, where = contexts[fresh], np.cumsum(fresh, dtype=np.int32) - np.int32(1)
        rank, known = self.contexts.successors(asked)
        rank = np.where(known, rank, 0)
        order = np.flatnonzero(known)
        begin, end, base, last = (np.zeros(len(asked), dtype=np.int64) for _ in range(4))
        begin[order], end[order] = self.pointers.at(rank[order]), self.pointers.at(rank[order] + 1)
        order = order[end[order] > begin[order]]
        after = order[begin[order] > 0]
        base[after] = self.successors.at(begin[after] - 1).astype(np.int64) + 1
        last[order] = self.successors.at(end[order] - 1)
        filled = np.zeros(len(asked), dtype=bool)
        filled[order] = True
        found = np.full(len(contexts), NONE, dtype="<u2")
        some = np.flatnonzero(filled[where])
        relative, limit = base[where[some]] + successors[some].astype(np.int64), last[where[some]]
        place, seen = self.successors.successors(np.minimum(relative, limit + 1).astype(np.uint64))
        seen &= relative <= limit
        found[some[seen]] = self.codes[place[seen]]
        return found


REQUEST = "shard INT, block INT, contexts BINARY, context_counts BINARY, sizes BINARY, successors BINARY, counts BINARY"
ANSWER = "block INT, kind INT, shard INT, payload BINARY"


def _answers(blocks: list, kind: int, shard: int, payloads: list[bytes]) -> pa.Table:
    return pa.table({"block": pa.array(blocks, pa.int32()), "kind": pa.array([kind] * len(blocks), pa.int32()),
                     "shard": pa.array([shard] * len(blocks), pa.int32()), "payload": pa.array(payloads, pa.binary())})


def score_documents(docs: DataFrame, train: Column, strength: float = 100.0, block_bytes: int = 12 << 20) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every document.

    The model learns from documents for which ``train`` holds; scores are
    log10 probabilities of the whole text with its end.
    """
    texts = docs.select("doc_id", "text", train.alias("train"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = n_shards = int(total // block_bytes) + 1
    id_type = docs.schema["doc_id"].dataType.simpleString()
    counts = staged(count_words(texts.filter("train")), "word-counts")
    seen = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_train, denominator = seen["n"] or 0, (seen["n"] or 0) + seen["v"] + 1
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(n_blocks)).cast("int"))

    def ask_words(key: tuple, table: pa.Table) -> pa.Table:
        block = _Block(table, n_shards)
        rows = [(shard, block.words[places].tobytes()) for shard, places in block.word_slices()]
        return pa.table({"shard": pa.array([s for s, _ in rows], pa.int32()), "block": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                         "keys": pa.array([k for _, k in rows], pa.binary())})

    def answer_words(key: tuple, asked: pa.Table, known: pa.Table) -> pa.Table:
        words = known.column("key").to_numpy().view(np.uint64)
        order = np.argsort(words)
        words, n = words[order], known.column("n").to_numpy()[order]
        payloads = []
        for data in asked.column("keys"):
            wanted = np.frombuffer(data.as_py(), dtype=np.uint64)
            place = np.minimum(np.searchsorted(words, wanted), max(0, len(words) - 1))
            found = np.where(words[place] == wanted, n[place], 0) if len(words) else np.zeros(len(wanted))
            payloads.append(found.astype("<i8").tobytes())
        return _answers(asked.column("block").to_pylist(), 1, key[0].as_py(), payloads)

    def ask_bigrams(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ("shard", "contexts", "context_counts", "sizes", "successors", "counts")
        rows = {c: [] for c in names}
        if table.num_rows:
            block = _Block(table, n_shards)
            block.take_counts(answers)
            block.bigrams()
            learn = np.repeat(table.column("train").to_numpy(), np.diff(block.first)).astype(float)
            count = np.bincount(block.pair, weights=learn, minlength=len(block.pair_order)).astype("<u4")[block.pair_order]
            c1 = block.context_count[block.pair_context[block.pair_order]]
            for shard, part in block.pair_slices():
                a = block.a[part]
                begins = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
                for c, v in zip(names, (shard, _short(a[begins]), c1[part][begins].astype("<i8").tobytes(),
                                        np.diff(np.append(begins, len(a))).astype("<u4").tobytes(),
                                        _short(block.b[part]), count[part].tobytes())):
                    rows[c].append(v)
        n = len(rows["shard"])
        return pa.table({"shard": pa.array(rows["shard"], pa.int32()), "block": pa.array([key[0].as_py()] * n, pa.int32()),
                         **{c: pa.array(rows[c], pa.binary()) for c in names[1:]}})

    def answer_bigrams(key: tuple, asked: pa.Table) -> pa.Table:
        column = {c: [v.as_py() for v in asked.column(c)] for c in ("contexts", "context_counts", "sizes", "successors", "counts")}
        sizes = [np.frombuffer(s, dtype="<u4") for s in column["sizes"]]
        own = [_long(c) for c in column["contexts"]]
        contexts, first = np.unique(np.concatenate(own), return_index=True)
        c1 = np.concatenate([np.frombuffer(c, dtype="<i8") for c in column["context_counts"]])[first]
        entries = np.concatenate([(np.repeat(np.searchsorted(contexts, c).astype(np.uint64) << np.uint64(8 * KEY_BYTES), s)) | _long(b)
                                  for c, s, b in zip(own, sizes, column["successors"])])
        weights = np.concatenate([np.frombuffer(c, dtype="<u4") for c in column["counts"]])
        ends = np.cumsum([0] + [int(s.sum()) for s in sizes])
        del own, first, sizes, column
        # Every different bigram of the shard is counted and looked up once, whatever number of blocks ask for it.
        entries, where = np.unique(entries, return_inverse=True)
        where = where.astype(np.uint32)
        totals = np.bincount(where, weights=weights, minlength=len(entries))
        rank, successors = (entries >> np.uint64(8 * KEY_BYTES)).astype(np.int64), entries & np.uint64((1 << 8 * KEY_BYTES) - 1)
        del entries, weights
        held, store = totals > 0, Store()
        try:
            trie = Trie(contexts, c1, rank[held], successors[held], totals[held], strength, store)
            codes = np.empty(len(rank), dtype="<u2")
            for low in range(0, len(rank), LOOKED_UP):
                part = slice(low, low + LOOKED_UP)
                codes[part] = trie.look_up(contexts[rank[part]], successors[part])
            codes = codes[where]
        finally:
            store.close()
        payloads = [codes[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        return _answers(asked.column("block").to_pylist(), 2, key[0].as_py(), payloads)

    def score(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(table, n_shards)
        block.take_counts(answers)
        block.bigrams()
        given = _payloads(answers, 2)
        codes = np.full(len(block.pair_order), NONE, dtype=np.int64)
        for shard, part in block.pair_slices():
            codes[block.pair_order[part]] = np.frombuffer(given[shard], dtype="<u2")
        unigram = (block.count + 1) / denominator
        c1 = block.context_count[block.pair_context]
        p = np.where(codes == NONE, 0.0, 10.0 ** (-codes / STEP)) + strength / (c1 + strength) * unigram[block.pair_word]
        first = block.first[:-1]
        return pa.table({
            "doc_id": table.column("doc_id"), "held_out": pa.array(~table.column("train").to_numpy().astype(bool)),
            "n_tokens": pa.array(np.diff(block.first)),
            "n_known": pa.array(np.add.reduceat((block.count > 0)[block.word].astype(np.int64), first)),
            "train_tokens": pa.array(np.full(len(first), n_train, dtype=np.int64)),
            "base_score": pa.array(np.add.reduceat(np.log10(unigram)[block.word], first)),
            "score": pa.array(np.add.reduceat(np.log10(p)[block.pair], first))})

    asked = dealt.groupBy("block").applyInArrow(ask_words, "shard INT, block INT, keys BINARY")
    known = counts.withColumn("shard", F.pmod("key", F.lit(n_shards)).cast("int"))
    words = asked.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(answer_words, ANSWER)
    bigrams = dealt.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(ask_bigrams, REQUEST)
    shares = bigrams.groupBy("shard").applyInArrow(answer_bigrams, ANSWER)
    return dealt.groupBy("block").cogroup(words.union(shares).groupBy("block")).applyInArrow(
        score, f"doc_id {id_type}, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, "
               "base_score DOUBLE, score DOUBLE")
