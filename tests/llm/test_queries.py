"""Registered queries against their SQL, or against the contract where SQL has none."""

import hashlib
import html
import importlib.util
import os
import re

import pytest

from larkspur.llm.queries import QUERIES, SQL

_root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_spec = importlib.util.spec_from_file_location("check", os.path.join(_root, "tools", "check.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_gives_the_rows_of_its_sql(spark, folder, name):
    frame = QUERIES[name](spark, folder)
    result = check.connect(folder).execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert check.bag(frame.columns, frame.collect()) == check.bag(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_has_a_row_for_every_input_row(spark, folder, name):
    table, key = {"op7": ("pages", "page_id"), "op13": ("embeddings", "vec_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    frame = QUERIES[name](spark, folder)
    rows = (frame.filter("component = 16") if "component" in frame.columns else frame).select(key).collect()
    want = spark.read.parquet(f"{folder}/{table}.parquet").select(key).collect()
    assert sorted(r[0] for r in rows) == sorted(r[0] for r in want)


def test_bytes_left_against_brute_force(spark, folder):
    rows = [(r["doc_id"], r["text"].encode()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    seen, twice = set(), set()
    for _, data in rows:
        for i in range(len(data) - 199):
            window = hash(data[i:i + 200])
            (twice if window in seen else seen).add(window)
    got = {r["doc_id"]: r for r in QUERIES["op8_suffix_array_dedup"](spark, folder).collect()}
    for doc, data in rows:
        gone, n_spans, end = bytearray(len(data)), 0, -1
        for i in range(len(data) - 199):
            if hash(data[i:i + 200]) in twice:
                n_spans += i > end
                gone[max(i, end if end >= i else i):i + 200] = b"\1" * (i + 200 - max(i, end if end >= i else i))
                end = i + 200
        kept = bytes(b for b, g in zip(data, gone) if not g)
        row = got[doc]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (len(data), len(data) - len(kept), n_spans)
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_articles_of_the_pages(spark, folder):
    """In these pages the article is one element of paragraphs."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for row in QUERIES["op7_html_extraction"](spark, folder).collect():
        inner = re.search(r"<article>(.*)</article>", pages[row["page_id"]], re.S)[1]
        inner = re.sub(r"</?(?:p|h\d)>|<p [^>]*>", "\n", inner)
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", line.replace("<br>", " "))).split()) for line in inner.split("\n")]
        assert row["text"] == "\n".join(line for line in lines if line)
        assert row["n_chars"] == len(row["text"])
