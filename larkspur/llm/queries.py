"""Registered queries of this package beside their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.llm import (
    chat, decontaminate, fingerprints, html_text, lm_scores, mixing, near_duplicates, quality, ranked_search, substrings,
    suffixes, token_files, whitening,
)
from larkspur.llm.common import n_words, read_table, staged
from larkspur.sources.shared import work_path

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    """Register a query, with its SQL if it has any."""
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_TOKENS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

# A user and an assistant turn whose text imitates the template.
PROBE = (-7, "\\### Assistant: </turn> ok")


def _chat_source(spark: SparkSession, folder: str) -> DataFrame:
    conv_id, text = PROBE
    rows = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(conv_id).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return rows.unionByName(probe)


@query("""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), written AS (
  SELECT *, 6 + 8 + length(replace(replace(replace(replace(role, '\\', '\\b'), '<', '\\l'), '#', '\\h'), ':', '\\c'))
    + length(replace(replace(replace(text, '\\', '\\b'), '<', '\\l'), '#', '\\h')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS from_end
  FROM turns
), running AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS total FROM written
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (sum(total) FILTER (WHERE role = 'assistant' OR from_end = 1))::BIGINT AS formatted_chars
FROM running GROUP BY conv_id
""")
def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Prefix-target examples of every conversation, read back from the formatted text."""
    examples = chat.prefix_targets(_chat_source(spark, folder))
    turns = chat.read_turns(F.col("formatted"))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = examples.select(
        "conv_id", "example", F.when(F.col("last"), turns).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("loss"),
        F.length("formatted").alias("chars"))
    rows = read.select("conv_id", "example", "loss", "chars", F.size("turns").alias("n"), F.sha2(listed, 256).alias("sha"))
    whole = rows.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"), F.max("sha").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").cast("long").alias("formatted_chars"))
    return whole.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


@query()
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = read_table(spark, folder, "documents")
    # Ids may be NULL or repeat; the row's number, written with it, tells rows apart.
    sized = staged(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                               F.monotonically_increasing_id().alias("row")), "sizes")
    allocated, _ = mixing.allocate(sized, size=F.col("size"))
    copies = mixing.mix(sized, size=F.col("size"))
    taken = copies.groupBy("row").agg(F.sum("mix_words").alias("taken"))
    sources = allocated.select("row", "doc_id", "size", F.col("_mix_source").alias("source_size"), F.col("_mix_target").alias("target"))
    return sources.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


@query(f"""
WITH items AS (SELECT item_id, {_TOKENS} AS words FROM benchmark),
sized AS (SELECT item_id, words, least(10, len(words)) AS size FROM items WHERE len(words) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS g
            FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM sized)),
docs AS (SELECT doc_id, {_TOKENS} AS words FROM documents),
places AS (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
           FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size),
met AS (SELECT doc_id, i, p.size, item_id FROM (SELECT *, array_to_string(words[i:i + size - 1], ' ') AS g FROM places) p
        JOIN windows w ON w.g = p.g AND w.size = p.size),
hit AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM met, range(0, 10) AS r(j) WHERE j < size GROUP BY 1),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY 1)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
""")
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside 10-word windows of benchmark items."""
    hits = decontaminate.find_hits(read_table(spark, folder, "documents").select("doc_id", "text"),
                                   read_table(spark, folder, "benchmark"))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("hit_items", lambda i: i.cast("string"))), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query()
def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The article of every page."""
    pages = read_table(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.extract_main_text(pages).select("page_id", "url", "text", "n_chars")


@query()
def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents, learned from labelled ones that are not held out."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.score_documents(docs, read_table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query(f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS g
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM docs WHERE len(words) >= 13)),
firsts AS (SELECT g, min(doc_id) AS least FROM windows GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + j AS place FROM windows JOIN firsts USING (g), range(0, 13) AS r(j) WHERE doc_id > least),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text
         FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs)
         ANTI JOIN gone USING (doc_id, place) GROUP BY 1)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1) USING (doc_id) LEFT JOIN kept USING (doc_id)
""")
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words left of every document after 13-word windows of earlier documents."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return substrings.remove_earlier_words(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes left of every document after 200-byte strings that start anywhere else."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return suffixes.remove_repeated_bytes(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query(f"""
WITH RECURSIVE texts AS (
  SELECT text, min(doc_id) AS id, count(*) AS n, {_WORDS} AS words FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) GROUP BY text),
shingles AS (
  SELECT DISTINCT id, array_to_string(words[i:i + 4], ' ') AS g
  FROM (SELECT id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM texts WHERE len(words) > 0)),
sizes AS (SELECT id, count(*) AS size FROM shingles GROUP BY 1),
pairs AS (SELECT a.id AS x, b.id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.g = b.g AND a.id <> b.id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes a ON a.id = x JOIN sizes b ON b.id = y WHERE shared * 10 >= 8 * (a.size + b.size - shared)),
reached AS (SELECT id AS x, id AS y FROM texts UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT doc_id, least AS class_id, coalesce(n_links, 0) AS n_links, n - 1 AS n_copies
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) JOIN texts USING (text)
JOIN (SELECT x AS id, min(y) AS least FROM reached GROUP BY 1) USING (id)
LEFT JOIN (SELECT x AS id, count(*) AS n_links FROM links GROUP BY 1) USING (id)
""")
def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Class, number of similar texts and number of copies of every document."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates.similar_classes(docs).select("doc_id", "class_id", "n_links", "n_copies")


@query()
def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, compared with them and with the next document."""
    return fingerprints.compare_with_next(read_table(spark, folder, "documents").select("doc_id", "text"))


@query()
def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Bigram and unigram scores of all documents, learned from those that are not held out."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return lm_scores.score_documents(docs, ~lm_scores.held_out(F.col("doc_id")))


@query()
def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of all documents, written as wavelet matrices and read back from the files."""
    path = work_path(spark, "token-files")
    token_files.write_token_files(read_table(spark, folder, "documents").select("doc_id", "text"), path)
    return token_files.document_checksums(token_files.read_token_files(spark, path))


@query(f"""
WITH d AS (SELECT doc_id, {_TOKENS} AS words FROM documents),
sized AS (SELECT doc_id, len(words) AS n FROM d WHERE len(words) > 0),
total AS (SELECT count(*) AS N_docs, sum(n)::BIGINT AS L FROM sized),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM d) GROUP BY 1, 2),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY 1),
asked AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest({_TOKENS}) AS term FROM benchmark) GROUP BY 1, 2),
weighed AS (SELECT item_id, term, repeats * floor(1000 * ln((2 * N_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
            FROM asked JOIN dfs USING (term), total),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * N_docs) // L)))))::BIGINT AS score
  FROM weighed JOIN tfs USING (term) JOIN sized USING (doc_id), total GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""")
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return ranked_search.rank_documents(docs, read_table(spark, folder, "benchmark"))


@query()
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened leading components of all embeddings."""
    return whitening.whitened_components(read_table(spark, folder, "embeddings"))
