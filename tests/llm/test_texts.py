"""Decontamination, chat formatting, HTML extraction, fingerprints."""

import hashlib
import random
import re
import sys
import time
from collections import Counter

import numpy as np
import pytest
from conftest import prose

from larkspur.llm import chat, decontaminate, fingerprints
from larkspur.llm.automaton import Automaton
from larkspur.llm.html_text import main_text, extract_main_text

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def hits(text, items, n=10):
    words = TOKEN.findall(lower(text))
    hit, found = set(), set()
    for key, item in items:
        own = TOKEN.findall(lower(item))
        size = min(n, len(own))
        windows = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1 if windows else 0):
            if tuple(words[i:i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(key)
    return len(words), len(hit), sorted(found)


@pytest.fixture(scope="module")
def leaky(spark):
    rng = random.Random(5)
    items = [(i, prose(rng, rng.choice([3, 9, 10, 11, 40]), 30)) for i in range(25)] + [(50, ""), (51, None), (52, "w1"), (53, "W1, w2!"), (54, "w1 w2")]
    items.append((60, items[0][1]))
    texts = [prose(rng, 50, 30) for _ in range(30)]
    for i, (_, item) in enumerate(items[:25]):
        texts.append(f"{prose(rng, 5)} {item.upper()}; {prose(rng, 5)} {item[:len(item) // 2]}")
    texts += ["", None, "Ä ö w1"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    return docs, spark.createDataFrame(items, "item_id BIGINT, text STRING"), list(enumerate(texts)), items


@pytest.mark.parametrize("limit", [1_000_000, 60])
def test_hits_against_brute_force(leaky, limit):
    docs, benchmark, texts, items = leaky
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["hit_items"])) for r in
           decontaminate.find_hits(docs, benchmark, words_per_automaton=limit).collect()}
    assert got == {i: hits(t, items) for i, t in texts}


def test_a_large_benchmark_passes_in_bounded_parts(leaky, spark, monkeypatch):
    """No automaton exceeds its words, a long item is cut without losing a window, and hits of all parts meet."""
    rng = random.Random(8)
    long_item = prose(rng, 230, 300)
    items = [*leaky[3][:25], (70, long_item), (71, prose(rng, 61, 300)), (None, prose(rng, 12, 300))]
    words = long_item.split()
    texts = [f"{prose(rng, 4)} {' '.join(words[i:i + 10])} {prose(rng, 4)}" for i in range(0, 221)]
    texts += [long_item, " ".join(words[30:150]), items[26][1], items[27][1], items[26][1], None, ""] + [t for _, t in leaky[2]]
    sizes, build = [], decontaminate.Automaton.__init__

    def recorded(self, items, window):
        items = list(items)
        sizes.append(sum(len(words) for _, words in items))
        build(self, items, window)

    monkeypatch.setattr(decontaminate.Automaton, "__init__", recorded)
    frame = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING")
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    got = decontaminate.find_hits(frame, benchmark, words_per_automaton=60).collect()
    assert len(sizes) > 5 and max(sizes) <= 60

    def row(doc, n, hit, found):
        return doc, n, hit, tuple(sorted(found, key=lambda x: (x is not None, x or 0)))

    def expected(text):
        named = [(-1 if key is None else key, item) for key, item in items]
        n, hit, found = hits(text, named)
        return n, hit, [None if key == -1 else key for key in found]

    assert Counter(row(r["doc_id"], r["n_words"], r["n_hit"], r["hit_items"]) for r in got) == Counter(
        row(i // 2, *expected(t)) for i, t in enumerate(texts))
    one = {(r["doc_id"], r["text"]) for r in decontaminate.decontaminate(frame, benchmark).collect()}
    assert one == {(r["doc_id"], r["text"]) for r in decontaminate.decontaminate(frame, benchmark, words_per_automaton=60).collect()}


@pytest.mark.parametrize("pass_bytes", [1, 20_000])
def test_passes_give_what_one_pass_gives(leaky, pass_bytes):
    docs, benchmark, texts, items = leaky
    parts = decontaminate.parts_of(benchmark, 10, 60)
    passes = [held for held, _ in decontaminate.automata(parts, 10, pass_bytes)]
    assert len(passes) > 2 and all(len(held) == 1 or sum(a.n_bytes() for a in held) <= pass_bytes for held in passes)
    assert len(list(decontaminate.automata(parts, 10, 256 << 20))) == 1
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["hit_items"])) for r in
           decontaminate.find_hits(docs, benchmark, words_per_automaton=60, pass_bytes=pass_bytes).collect()}
    assert got == {i: hits(t, items) for i, t in texts}
    options = {"words_per_automaton": 60, "pass_bytes": pass_bytes}
    assert {tuple(r) for r in decontaminate.decontaminate(docs, benchmark, **options).collect()} == {
        tuple(r) for r in decontaminate.decontaminate(docs, benchmark).collect()}


def test_automaton_is_small():
    """Flat arrays: far below the kilobyte a word that a dictionary for each state takes."""
    rng = random.Random(11)
    words = [f"w{int(rng.paretovariate(0.8)) % 20000}".encode() for _ in range(60_000)]
    automaton = Automaton([(i, words[low:low + 300]) for i, low in enumerate(range(0, 60_000, 300))], 10)
    own = sum(sys.getsizeof(word) + 32 for word in set(words)) + sys.getsizeof(automaton.ids)
    assert automaton.n_bytes() - own < 100 * len(words)
    assert automaton.scan(words[300:600])[0] == [[0, 300]]
    assert 1 in automaton.scan(words[305:316])[1] and automaton.scan(words[305:314])[0] == []


def test_clean_texts_stay_and_spans_go(leaky, spark):
    docs, benchmark, texts, items = leaky
    long_items = benchmark.filter("item_id < 25")
    kept = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, long_items, max_coverage=0.9).collect()}
    for i, text in texts:
        n, hit, _ = hits(text, items[:25])
        assert (i in kept) == (hit <= 0.9 * n)
        if i in kept and not hit:
            assert kept[i] == text
        elif i in kept:
            assert len(TOKEN.findall(lower(kept[i]))) == n - hit


def test_empty_benchmark_and_documents(leaky, docs, no_docs):
    assert decontaminate.find_hits(docs, leaky[1].limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.decontaminate(no_docs, leaky[1]).count() == 0
    assert decontaminate.decontaminate(docs, leaky[1].limit(0)).columns == docs.columns


def test_clashing_columns(odd_docs, leaky):
    out = decontaminate.find_hits(odd_docs, leaky[1])
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    assert out.count() == odd_docs.count()


def test_chat_round_trip(spark):
    rng = random.Random(2)
    control = ["### assistant: ", "</turn>\n", "\\", "<", "#", ":", "\\b", "\\\\l", "é", "\n", "x y", ""]
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "system", "a:b <#\\", None]),
                         "".join(rng.choices(control, k=rng.randrange(6))) if rng.random() < 0.9 else None))
    rows += [(100, 0, "user", "only a question"), (None, 1, "assistant", "b"), (None, 0, "user", "a"), (101, 1, "assistant", "same"), (101, 1, "assistant", "same")]
    frame = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    from pyspark.sql import functions as F

    examples = chat.prefix_targets(frame.withColumn("formatted", F.lit(1))).select(
        "*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_turns(F.col("context")).alias("before"),
        chat.loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("loss")).collect()
    for conv in {r[0] for r in rows}:
        turns = [(role or "", text or "") for _, _, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], r[2] or "", r[3] or ""))]
        own = sorted((e for e in examples if e["conv_id"] == conv), key=lambda e: e["example"])
        places = [i for i, (role, _) in enumerate(turns) if role == "assistant" or i == len(turns) - 1]
        assert len(own) == len(places)
        for example, place in zip(own, places):
            assert [tuple(t) for t in example["turns"]] == turns[:place + 1]
            assert [tuple(t) for t in example["before"]] == turns[:place]
            assert example["loss"] == (turns[place][1] if turns[place][0] == "assistant" else "")
    assert chat.prefix_targets(frame.limit(0)).count() == 0


ARTICLE = "<h1>A title</h1><p>The first paragraph of the text is here &amp; it has&nbsp;many words.</p><p>Short.</p>"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<p", ""), ("just a line of the text", "just a line of the text"),
    (f"<nav><a href=x>Home</a></nav><article>{ARTICLE}</article><footer>The end of the page is here</footer>",
     "A title\nThe first paragraph of the text is here & it has many words.\nShort."),
    (f"<body><header><p>The name of the site and the slogan for it</p></header><div id='main-content'>{ARTICLE}</div>"
     "<div class='cookie-notice'>This is the notice of the cookies that we use</div>"
     "<form>Name of the user <input name=a></form><aside>Read this and that in the sidebar</aside>"
     "<section class=comments><p>I think that this is the best of all the texts.</p></section></body>",
     "A title\nThe first paragraph of the text is here & it has many words.\nShort."),
    ("<article><p>One <b>bold<br>line</b> &lt;tag&gt; &#233;</p><script>if (a < b) document.write('<p>no</p>')</script>"
     "<!-- <p>no</p> --><style>p{}</style><p>Two\n\t of   the</article><p>The outside of the article is not a part of it.</p>",
     "One bold line <tag> é\nTwo of the"),
    ("<article><ul><li>First of the list<li>Second of the list</ul><div class=advert><p>Buy this in the shop of the day</p></div></article>",
     "First of the list\nSecond of the list"),
])
def test_main_text(page, text):
    assert main_text(page) == text


LONG_P = "This is the paragraph of the article that has to be kept, for it is long enough and it is full of good words."


@pytest.mark.parametrize("page, text", [
    (f"<p title=it's>{LONG_P}</p><p title='a>b'>{LONG_P}</p>", f"{LONG_P}\n{LONG_P}"),
    (f'<p title="never closed>{LONG_P}</p>', LONG_P),
    (f'<body><div class="site has-sidebar"><article><p>{LONG_P}</p></article><div class=sidebar><p>{LONG_P}</p></div></div>', LONG_P),
    (f'<body><div class="content-sidebar-wrap"><main><p>{LONG_P}</p></main></div>', LONG_P),
    (f'<form id="aspnetForm"><h1>Title</h1><p>{LONG_P}</p><div class=footer><p>The end of the page</p></div></form>', f"Title\n{LONG_P}"),
    # Where an article is marked outside of all such names, they keep their force.
    (f"<article><p>{LONG_P}</p></article><section class=comments><article><p>{LONG_P}{LONG_P}</p></article></section>", LONG_P),
    # A leaflet of few words does not speak for the page.
    ("<div class=ad><p>Buy this in the shop of the day</p></div><p>" + "Qwx | vbn | " * 20 + "</p>", ("Qwx | vbn | " * 20).strip()),
    # Long lines without stop words: with their neighbours, and dropped between bad ones.
    (f"<p>{LONG_P}</p><p>{'Modell ZX-81 ' * 8}</p><p>{LONG_P}</p>", f"{LONG_P}\n{('Modell ZX-81 ' * 8).strip()}\n{LONG_P}"),
    (f"<p>{LONG_P}</p><ul><li><a>a</a></li><li><a>b</a></li></ul><p>{'Modell ZX-81 ' * 8}</p><footer>The end</footer>", LONG_P),
])
def test_names_and_quotes_lose_no_article(page, text):
    assert main_text(page) == text


def test_pages_that_mark_no_article(spark, folder):
    """With the marks taken out, nearly all pages give the same text, and none loses its article."""
    same = total = 0
    for row in spark.read.parquet(f"{folder}/pages.parquet").collect():
        plain = re.sub(r"</?(?:article|main)\b[^>]*>", "", row["html"])
        want, got = main_text(row["html"]), main_text(plain)
        total += 1
        same += want == got
        assert len(got) >= 0.8 * len(want) - 60, row["page_id"]
    assert same >= 0.9 * total


def test_nesting_takes_linear_time():
    began = time.process_time()
    assert main_text("<font><div>" * 50_000 + LONG_P) == LONG_P
    assert main_text("<font>" * 50_000 + "<p>" * 50_000 + LONG_P) == LONG_P
    assert main_text("<div class=menu>" * 50_000 + "x") == ""
    assert time.process_time() - began < 15


def test_extraction_of_a_table(spark):
    pages = spark.createDataFrame([(1, "u", None, 5), (2, "u", "<p>The text of the page</p>", 5), (2, "u", "<p>The text of the page</p>", 5)],
                                  "page_id BIGINT, url STRING, html STRING, text INT")
    got = Counter((r["page_id"], r["text"], r["n_chars"]) for r in extract_main_text(pages).collect())
    assert got == Counter({(1, "", 0): 1, (2, "The text of the page", 20): 2})
    assert extract_main_text(pages.limit(0)).count() == 0


def test_entropies_by_definition():
    rng = np.random.default_rng(0)
    data = np.concatenate([rng.integers(0, 5, 150), np.zeros(80), rng.integers(0, 256, 200)]).astype(np.uint8)
    for i, bin_ in enumerate(fingerprints.entropy_bins(data)):
        counts = np.bincount(data[i:i + 64])
        share = counts[counts > 0] / 64
        assert abs(-(share * np.log2(share)).sum() / 6 * 1000 - bin_) <= 1.01


def test_fingerprints_do_not_depend_on_neighbours(corpus):
    texts = [(t or "").encode() for _, t in corpus]
    ranks = fingerprints.rarity(np.arange(fingerprints.BINS)[::-1])
    together = [fingerprints.as_string(f) for f in fingerprints.digest(texts, ranks)]
    alone = [fingerprints.as_string(fingerprints.digest([t], ranks)[0]) for t in texts]
    assert together == alone
    for value in together:
        assert fingerprints.as_string(fingerprints.from_string(value)) == value


def test_next_document_and_edits(spark, docs, corpus, odd_docs, no_docs):
    got = {r["doc_id"]: r for r in fingerprints.compare_with_next(docs).collect()}
    prints = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs).collect()}
    texts = [t or "" for _, t in corpus]
    for i, text in enumerate(texts):
        half, after = len(text) // 2, texts[(i + 1) % len(texts)]
        edited = text[:len(text) - half] + after[:half]
        row = got[i]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == prints[i] and 0 <= row["near_edited"] <= 1
        if after == text:
            assert row["near_next"] == 1 and row["fingerprint"] == prints[(i + 1) % len(texts)]
    assert fingerprints.compare_with_next(odd_docs).count() == odd_docs.count()
    assert fingerprints.compare_with_next(no_docs).count() == 0
    one = spark.createDataFrame([(1, "abcd")], "doc_id BIGINT, text STRING")
    assert fingerprints.compare_with_next(one).first()["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def test_order_over_many_buckets(docs, corpus):
    ordered = fingerprints.in_id_order(docs, rows_per_bucket=7)
    rows = ordered.select("bucket", "borrowed", "doc_id").collect()
    own = sorted((r["bucket"], r["doc_id"]) for r in rows if not r["borrowed"])
    assert [d for _, d in own] == [i for i, _ in corpus] and len({b for b, _ in own}) > 5
    borrowed = {r["bucket"]: r["doc_id"] for r in rows if r["borrowed"]}
    last = {b: d for b, d in own}
    assert all(borrowed[b] == (d + 1) % len(corpus) for b, d in last.items())
