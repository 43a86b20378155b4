"""Substring dedup and suffix-array dedup against brute force."""

import random
import string
from collections import Counter

import numpy as np
import pytest
from conftest import words_of

from larkspur.llm import repeats, substrings, suffixes
from larkspur.llm.anchors import Words, runs


def earlier_words(rows, n):
    first = {}
    for doc, text in rows:
        words = words_of(text)
        for i in range(len(words) - n + 1):
            window = tuple(words[i:i + n])
            known = first.get(window, float("inf"))
            first[window] = min(known, float("inf") if doc is None else doc)
    out = []
    for doc, text in rows:
        words = words_of(text)
        gone = set()
        for i in range(len(words) - n + 1):
            if first[tuple(words[i:i + n])] < (float("inf") if doc is None else doc):
                gone.update(range(i, i + n))
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return Counter(out)


def repeated_bytes(rows, n):
    counts = Counter()
    for _, text in rows:
        data = (text or "").encode()
        counts.update(data[i:i + n] for i in range(len(data) - n + 1))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, dtype=int)
        for i in range(len(data) - n + 1):
            if counts[data[i:i + n]] > 1:
                gone[i] += 1
                gone[i + n] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        out.append((doc, len(data), int(gone.sum()), bytes(np.frombuffer(data, np.uint8)[~gone])))
    return Counter(out)


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
@pytest.mark.parametrize("n", [13, 6])
def test_earlier_words(request, which, n):
    frame = request.getfixturevalue(which)
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    got = substrings.remove_earlier_words(frame, n).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert Counter(map(tuple, got)) == earlier_words(rows, n)


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
@pytest.mark.parametrize("n", [200, 50])
def test_repeated_bytes(request, which, n):
    frame = request.getfixturevalue(which)
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    got = suffixes.remove_repeated_bytes(frame, n).select("doc_id", "n_bytes", "n_removed", "kept").collect()
    assert Counter((a, b, c, bytes(d)) for a, b, c, d in got) == repeated_bytes(rows, n)


@pytest.mark.parametrize("earlier", [True, False])
def test_anchors_with_many_spans_are_compared_as_rows(docs, corpus, monkeypatch, earlier):
    """With ``wide`` at 1 every edge takes the path of very hot anchors."""
    narrow = repeats.Repeats

    def wide(**settings):
        return narrow(**settings, wide=1)

    monkeypatch.setattr(substrings if earlier else suffixes, "Repeats", wide)
    if earlier:
        got = substrings.remove_earlier_words(docs).select("doc_id", "n_words", "n_removed", "kept").collect()
        assert Counter(map(tuple, got)) == earlier_words(corpus, 13)
    else:
        got = suffixes.remove_repeated_bytes(docs).select("doc_id", "n_bytes", "n_removed", "kept").collect()
        assert Counter((a, b, c, bytes(d)) for a, b, c, d in got) == repeated_bytes(corpus, 200)


def test_repeats_after_different_text_meet_in_one_range(spark):
    """Copies of a passage whose runs begin in different text must not be dealt to different ranges."""
    rng = random.Random(11)

    def letters(n):
        return "".join(rng.choices(string.ascii_lowercase + " ", k=n))

    rows = []
    for _ in range(40):
        passage = letters(rng.randrange(200, 401))
        rows += [(len(rows) + i, letters(rng.randrange(160, 400)) + passage + letters(rng.randrange(160, 400))) for i in range(2)]
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "50"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(8)
        got = suffixes.remove_repeated_bytes(frame).select("doc_id", "n_bytes", "n_removed", "kept").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    want = repeated_bytes(rows, 200)
    assert min(n for _, _, n, _ in want) >= 200
    assert Counter((a, b, c, bytes(d)) for a, b, c, d in got) == want


@pytest.mark.parametrize("words", [True, False])
def test_matches_are_extended_both_ways(words):
    """Every window that two spans share is found, and no other, whatever their lengths and contexts."""
    rng = random.Random(4)
    n, k = (6, 2) if words else (12, 4)
    spec = repeats.Repeats(words=words, size=n, anchor=k, earlier=False)
    spans, anchors, at = [], [], []
    for _ in range(300):
        seed = rng.randrange(3)
        left, right = rng.randrange(n - k + 1), rng.randrange(n - k + 1)
        right = max(right, n - k - left)
        units = [rng.choice("xy") for _ in range(left)] + ["abc"[seed]] * k + [rng.choice("xy") for _ in range(right)]
        spans.append((" " if words else "").join(units).encode())
        anchors.append(seed)
        at.append(left)
    got = Counter()
    for rows, place, same in repeats.matches(spec, spans, np.array(anchors), np.array(at)):
        groups = {}
        for row, low, number in zip(rows, place, same):
            units = spans[row].split(b" ") if words else spans[row]
            groups.setdefault(int(number), set()).add((anchors[row], bytes(b" ".join(units[low:low + n]) if words else units[low:low + n])))
            got[(int(row), int(low))] += 1
        # Equal numbers stand for equal windows; with bytes, numbers rise in the order of the text.
        assert all(len(own) == 1 for own in groups.values())
    counts, where = Counter(), {}
    for row, span in enumerate(spans):
        units = span.split(b" ") if words else span
        for low in range(max(0, at[row] + k - n), min(at[row], len(units) - n) + 1):
            window = (anchors[row], at[row] - low, bytes(b" ".join(units[low:low + n]) if words else units[low:low + n]))
            counts[window] += 1
            where[(row, low)] = window
    assert got == Counter(place for place, window in where.items() if counts[window] > 1)


def test_suffixes_are_sorted_by_their_bytes():
    rng = np.random.default_rng(2)
    spans = [bytes(rng.integers(97, 99, 40, dtype=np.uint8)) for _ in range(500)]
    units = np.frombuffer(b"".join(spans), dtype=np.uint8).astype(np.int64)
    place = np.arange(500) * 40
    reach = repeats.extend(np.zeros(500, dtype=np.int64), place, np.full(500, 40), units, 1, 40)
    for j, known in enumerate(reach):
        rows = np.flatnonzero(known >= 0)
        heads = [spans[i][:j] for i in rows]
        assert [h for _, h in sorted(zip(known[rows], heads))] == sorted(heads)
        assert all(c > 1 for c in Counter(heads).values())
    assert len(reach) < 41


def test_limits_are_checked(spark):
    with pytest.raises(ValueError):
        repeats.Repeats(words=False, size=70_000, anchor=48, earlier=False)
    with pytest.raises(TypeError):
        substrings.remove_earlier_words(spark.createDataFrame([("a", "b")], "doc_id STRING, text STRING"))


def test_removed_spans_are_maximal(docs):
    for row in suffixes.remove_repeated_bytes(docs, 50).collect():
        spans = [(s["start"], s["end"]) for s in row["removed"]]
        assert sum(e - s for s, e in spans) == row["n_removed"]
        assert all(e - s >= 50 for s, e in spans)
        assert all(spans[i][1] < spans[i + 1][0] for i in range(len(spans) - 1))


def test_text_output_has_whole_characters(docs):
    for row in suffixes.remove_repeated_bytes(docs, 51, as_text=True).collect():
        assert "�" not in row["kept"]


def test_empty_table(no_docs):
    assert substrings.remove_earlier_words(no_docs).count() == 0
    assert suffixes.remove_repeated_bytes(no_docs).count() == 0


def test_every_window_is_in_one_run():
    rng = np.random.default_rng(1)
    first = np.array([0, 0, 30, 33, 90, 90, 200])
    pieces = rng.integers(0, 9, 200 - 3, dtype=np.uint64) << np.uint64(50)  # many ties
    text, anchor, low, high = runs(pieces, first, n=12, k=4)
    covered = [p for a, b in zip(low, high) for p in range(a, b + 1)]
    assert covered == [p for j in range(6) for p in range(first[j], first[j + 1] - 11)]
    for t, q, a, b in zip(text, anchor, low, high):
        for p in range(a, b + 1):
            window = pieces[p:p + 9]
            assert window[q - p] == window.min() and q == p + np.flatnonzero(window == window.min())[-1]


def test_words_of_a_buffer():
    texts = [b"", b" a  bc\n", b"\x0b", b"d", b"\xc2\xa0e f"]
    found = Words(texts)
    whole = found.data.tobytes()
    words = [whole[a:b] for a, b in zip(found.start, found.end)]
    assert words == [b"a", b"bc", b"d", b"\xc2\xa0e", b"f"]
    assert list(found.first) == [0, 0, 2, 2, 3, 5]
    assert whole == b"a bc d \xc2\xa0e f"


@pytest.mark.parametrize("limit", [1, 7, 20, 1000])
def test_blocks_keep_rows_in_order(limit):
    import pyarrow as pa

    from larkspur.llm.common import blocks

    texts = [[b"abc", b"", None, b"x" * 30], [], [b"de", b"f"], [b"g" * 9] * 3]
    batches = [pa.RecordBatch.from_arrays([pa.array(t, pa.binary())], names=["text"]) for t in texts]
    out = [b.column("text").to_pylist() for b in blocks(batches, limit)]
    assert sum(out, []) == sum(texts, [])
    assert all(len(own) == 1 or sum(len(t or b"") for t in own) <= limit for own in out)
    if limit == 1000:
        assert len(out) == 1
