import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Names that operators give to their results, and inner names, put on the input.
CLASHING = ["n_words", "n_removed", "kept", "removed", "covers", "score", "predicted", "held_out", "st_words", "n_hit",
            "hit_items", "mix_shard", "mix_size", "class_id", "key", "_key", "_mix_block"]


def words_of(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, repeats inside, empty and NULL ones."""
    rng = random.Random(7)
    texts = [prose(rng, rng.randrange(5, 160)) for _ in range(60)]
    passage = prose(rng, 60)
    texts += [f"{prose(rng, 20)} {passage} {prose(rng, 15)}" for _ in range(12)]
    texts += [texts[3]] * 4 + [texts[70]] * 3
    base = prose(rng, 120).split()
    for i in range(15):
        changed = list(base)
        changed[(7 * i) % 120] = f"new{i}"
        texts.append(" ".join(changed))
    texts += ["", None, "", None, "one", "one two", "same " * 300, "Ünïcode ß　text \U0001F600 " * 30, " \n\t ", "a" * 1000]
    texts.append(" ".join(prose(rng, 3000) for _ in range(2)))
    texts.append(texts[-1][:9000] + "  \n" + texts[0])
    return [(i, text) for i, text in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    rows = [(i, text, ["en", "de", None][i % 3], ["a", "b", "Z", None][min(i % 7, 3)], len(text or "")) for i, text in corpus]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").repartition(5).cache()


@pytest.fixture(scope="session")
def odd_docs(spark, corpus):
    """Repeated rows, equal and NULL ids, and extra columns with clashing names."""
    rows = [(i, t) for i, t in corpus[:70]] + corpus[:3] + corpus[:3] + [(None, corpus[4][1]), (None, None), (5, corpus[6][1]), (5, "one two")]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    from pyspark.sql import functions as F

    return frame.select("*", F.lit("s").alias("source"), *[F.lit(-1).alias(c) for c in CLASHING]).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
