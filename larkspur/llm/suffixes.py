"""Suffix-array dedup: drop every byte of a string that also starts anywhere else.

Suffixes are sampled by content (a window's anchor, see :mod:`anchors`), so a
repeat of ``size`` bytes holds a sampled suffix at the same place in each of
its copies.  Suffixes that stand for a whole repeated span are settled by
hash.  Those at the edges of repeats are range-partitioned by their leading
bytes, with splitters that Spark samples.  A range sorts them by multikey
quicksort: suffixes that agree so far are split by their next byte, all of
them at a time, and one that agrees with no other leaves.  The bytes before
them are sorted in the same way, backwards.  A string of ``size`` bytes is a
repeat where suffixes agree on its part from the anchor on and on that before.
Ranges are cut by the bytes
at the anchor itself, then by its hash, so equal anchors never fall into two
ranges, whatever text stands before them, and no comparison is missed across
boundaries; a leading anchor with very many suffixes is not one range's work
but is compared as rows, by 128-bit hashes of their windows, spread by content
(see :mod:`repeats`).

Texts are UTF-8 bytes; NULL counts as empty; matches never cross documents;
equal rows are documents of their own, so both lose what they share; an
empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from larkspur.llm.common import map_texts, text_bytes, without
from larkspur.llm.repeats import Repeats, covered_mask, covered_ranges, keyed
from larkspur.llm.substrings import SPANS, runs_of

OUT = ("n_bytes", "n_removed", "kept", "removed")


def remove_repeated_bytes(docs: DataFrame, size: int = 200, lead: int = 48, as_text: bool = False) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``kept`` and ``removed``.

    ``kept`` holds the remaining bytes; ``as_text``, it is a string without
    the parts of characters that a cut may leave.  ``removed`` lists the maximal removed runs as ranges of bytes.  Columns of
    ``docs`` with these names are replaced.
    """
    spec = Repeats(words=False, size=size, anchor=min(lead, size), earlier=False, lead=True)
    base = without(docs, [*OUT, "_key", "_doc", "key", "covers", "edges"])
    texts = keyed(base, earlier=False)
    ranges = covered_ranges(texts, spec)
    joined = texts.join(ranges, F.col("_key") == F.col("key"), "left")
    schema = T.StructType([*base.schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept", T.StringType() if as_text else T.BinaryType()), T.StructField("removed", SPANS)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, kept, removed = [], [], [], []
            for row, text in enumerate(text_bytes(batch.column("text"))):
                mask = covered_mask(batch.column("covers"), row, len(text))
                counts.append(len(text))
                gone.append(int(mask.sum()))
                left = np.frombuffer(text, dtype=np.uint8)[~mask].tobytes()
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
                removed.append([{"start": int(i), "end": int(j)} for i, j in zip(*runs_of(mask))])
            spans = pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in schema.names[:-4]), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.string() if as_text else pa.binary()), spans], names=schema.names)

    return map_texts(joined, cut, schema)
