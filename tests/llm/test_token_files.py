"""Token files against the tokenizer itself, and wavelet matrices against plain arrays."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larkspur.llm import token_files
from larkspur.llm.wavelet import WaveletMatrix

END = 1


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(token_files.tokenizer_path())


def plain(tokenizer, rows):
    """Documents in id order with their tokens; NULL ids last."""
    return [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [END])
            for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0))]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 90), max_size=700), st.integers(0, 90))
def test_matrix_answers_like_the_array(values, token):
    array = np.array(values, dtype=np.uint32) * 700
    ids, planes = WaveletMatrix.build(array).to_bytes()
    matrix = WaveletMatrix.from_bytes(ids, planes, len(array))
    token *= 700
    assert (matrix.tokens() == array).all()
    assert (matrix.occurrences(token) == np.flatnonzero(array == token)).all()
    assert (matrix.occurrences(token, 1, 3) == np.flatnonzero(array == token)[1:3]).all()
    if len(array):
        places = np.arange(len(array))
        assert (matrix.access(places) == array).all()
        assert (matrix.count(token, np.zeros_like(places), places + 1) == np.cumsum(array == token)).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_words_are_encoded_as_whole_texts_are(texts):
    import pyarrow as pa

    tokenizer = Tokenizer.from_file(token_files.tokenizer_path())
    encoder = token_files.Encoder(tokenizer.to_str(), True)
    ids, first = encoder(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [
        e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


ODD = ["it's we'll I'M, x", "<|endoftext|> a<|STARTOFTEXT|>b <|startoftext|>.", "Á, é. İ ΣΣ", "a\x1cb \xa0c d", "9.5, 1,000.",
       "!!, ??. ,. . ,", "ﬁn ß ǅ", "a" * 3000, "\x00 \x0b \x85 x", "你好，世界。 café."]


def test_odd_words(tokenizer):
    import pyarrow as pa

    ids, first = token_files.Encoder(tokenizer.to_str(), True)(pa.array(ODD))
    for text, a, b in zip(ODD, first[:-1], first[1:]):
        assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_each_different_word_is_encoded_once_and_keeps_one_entry(tokenizer, monkeypatch):
    import pyarrow as pa

    encoder, asked = token_files.Encoder(tokenizer.to_str(), True), []
    monkeypatch.setattr(encoder, "_ids", lambda word, ids=encoder._ids: asked.append(word) or ids(word))
    texts = ["alpha, beta. alpha, gamma", "gamma alpha, beta", "delta. beta."]
    for _ in range(2):
        ids, first = encoder(pa.array(texts))
        for text, a, b in zip(texts, first[:-1], first[1:]):
            assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    words = set(" ".join(texts).split())
    assert set(encoder.slots) == words and sorted(asked) == sorted([*words, ",", "."])


@pytest.mark.parametrize("kind", ["docs", "odd_docs"])
def test_files_give_all_tokens_back(spark, tokenizer, tmp_path, request, kind):
    docs = request.getfixturevalue(kind)
    token_files.write_token_files(docs, f"{tmp_path}/files", shard_tokens=500, range_bytes=20_000)
    shards = token_files.read_token_files(spark, f"{tmp_path}/files", shards_per_group=3)
    assert shards.count() > 10
    assert len(shards.inputFiles()) == shards.count()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain(tokenizer, rows)
    found = sorted(token_files.document_tokens(shards).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [d for d, _ in want]
    got = [np.frombuffer(r["tokens"], dtype="<u4").tolist() for r in found]
    assert sorted(map(str, zip((r["doc_id"] for r in found), got))) == sorted(map(str, want))
    assert [r["start"] for r in found] == np.cumsum([0] + [len(t) for t in got])[:-1].tolist()
    sums = {r["start"]: (r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files.document_checksums(shards).collect()}
    assert sums == {r["start"]: (r["doc_id"], len(t), zlib.crc32(np.array(t, dtype="<u4").tobytes())) for r, t in zip(found, got)}


def test_questions_to_the_files(spark, docs, tmp_path):
    token_files.write_token_files(docs, f"{tmp_path}/files", shard_tokens=2000, range_bytes=30_000)
    shards = token_files.read_token_files(spark, f"{tmp_path}/files")
    whole = [t for r in sorted(token_files.document_tokens(shards).collect(), key=lambda r: r["start"])
             for t in np.frombuffer(r["tokens"], dtype="<u4").tolist()]
    places = spark.createDataFrame([(i,) for i in (0, 1, 1, 777, len(whole) - 1, len(whole), -5, None)], "place BIGINT")
    assert sorted(map(tuple, token_files.token_at(shards, places).collect())) == [
        (i, whole[i]) for i in (0, 1, 777, len(whole) - 1)]
    for token in (END, whole[0], 49_000):
        assert sorted(r["place"] for r in token_files.find_token(shards, token).collect()) == [i for i, t in enumerate(whole) if t == token]
        counted = token_files.count_token(shards, token).agg(F.sum("n")).first()[0] or 0
        assert counted == whole.count(token)


def test_text_ids_whole_texts_and_empty_tables(spark, tokenizer, docs, no_docs, tmp_path):
    named = docs.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text")
    token_files.write_token_files(named, f"{tmp_path}/named", words=False, end_id=None, range_bytes=30_000)
    found = token_files.document_tokens(token_files.read_token_files(spark, f"{tmp_path}/named")).collect()
    want = {r["doc_id"]: tokenizer.encode(r["text"] or "", add_special_tokens=False).ids for r in named.collect()}
    assert {r["doc_id"]: np.frombuffer(r["tokens"], dtype="<u4").tolist() for r in found} == want
    assert [r["doc_id"] for r in sorted(found, key=lambda r: r["start"]) if r["n_tokens"]] == sorted(d for d, t in want.items() if t)
    token_files.write_token_files(no_docs, f"{tmp_path}/none")
    assert token_files.document_checksums(token_files.read_token_files(spark, f"{tmp_path}/none")).count() == 0
