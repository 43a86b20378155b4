"""Substring dedup by seed and extend: drop words that an earlier document already says.

Documents are joined on winnowed anchors (four-word seeds, the least hash of
every window).  Where the whole stretches around a seed are equal, they are
settled at once; else the matches of a seed are extended both ways, word by
word, to where no other document agrees, and those of ``window`` words and
more are kept: each word of a window that also starts in a document with a
smaller ``doc_id`` goes, and overlapping windows join to maximal repeats.  See
:mod:`repeats` for the steps and for how hot seeds are handled.

A word is a run of anything but the six ASCII white-space characters.  NULL
and empty texts have no words; texts shorter than a window keep everything;
ids must be whole numbers (a text column is a ``TypeError``);
rows with equal ids do not count as earlier than each other, a NULL id is
later than all others and earlier than none; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from larkspur.llm.anchors import Words
from larkspur.llm.common import map_texts, text_bytes, without
from larkspur.llm.repeats import Repeats, covered_mask, covered_ranges, keyed

OUT = ("n_words", "n_removed", "kept", "removed")
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return edges[0::2], edges[1::2]


def remove_earlier_words(docs: DataFrame, window: int = 13, seed_words: int = 4) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``kept`` and ``removed``.

    ``kept`` joins the words that stay by single spaces; ``removed`` lists the
    maximal repeats as ranges of words.  Columns of ``docs`` with these names
    are replaced.
    """
    spec = Repeats(words=True, size=window, anchor=min(seed_words, window), earlier=True)
    base = without(docs, [*OUT, "_key", "_doc", "key", "covers", "edges"])
    texts = keyed(base, earlier=True)
    ranges = covered_ranges(texts, spec)
    joined = texts.join(ranges, F.col("_key") == F.col("key"), "left")
    schema = T.StructType([*base.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept", T.StringType()), T.StructField("removed", SPANS)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, kept, removed = [], [], [], []
            for row, text in enumerate(text_bytes(batch.column("text"))):
                words = Words([text])
                mask = covered_mask(batch.column("covers"), row, len(words.start))
                counts.append(len(mask))
                gone.append(int(mask.sum()))
                starts, ends = runs_of(~mask)
                whole = words.data.tobytes()
                kept.append(b" ".join(whole[words.start[i]:words.end[j - 1]] for i, j in zip(starts, ends)).decode())
                removed.append([{"start": int(i), "end": int(j)} for i, j in zip(*runs_of(mask))])
            spans = pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in schema.names[:-4]), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.string()), spans], names=schema.names)

    return map_texts(joined, cut, schema)
