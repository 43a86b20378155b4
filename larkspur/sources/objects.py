"""Binary objects: scan whole files, keep them as a table, write them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_files(spark: SparkSession, path: str, name_pattern: str | None = None) -> DataFrame:
    """Files as ``(path, modificationTime, length, content)`` rows.

    File bytes are only read when ``content`` is selected.  Spark plans no
    scan for a file of zero bytes, so such a file gives no row.
    """
    reader = spark.read.format("binaryFile")
    if name_pattern is not None:
        reader = reader.option("pathGlobFilter", name_pattern)
    return reader.load(path)


def write_objects(objects: DataFrame, path: str) -> None:
    """Store ``(path, content)`` rows as one table, replacing an older one."""
    objects.select("path", "content").write.mode("overwrite").parquet(path)


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """Rows stored by :func:`write_objects`."""
    return spark.read.schema("path STRING, content BINARY").parquet(path)


CHUNKS = "path STRING, part INT, n_parts INT, length BIGINT, bytes BINARY, digest STRING, object_digest STRING"


def cut_objects(objects: DataFrame, chunk_bytes: int = 64 << 20) -> DataFrame:
    """``(path, content)`` rows as chunks that are a chain: part, number of parts, and digests.

    ``digest`` is the SHA-256 of a chunk, ``object_digest`` that of all its
    object's digests in order, so that neither a chunk nor its place can change
    unseen.  An object of zero bytes is one empty chunk.
    """
    content = F.coalesce("content", F.lit(b""))
    n_parts = F.greatest(F.lit(1), F.ceil(F.length(content) / F.lit(chunk_bytes))).cast("int")
    piece = F.transform(F.sequence(F.lit(0), F.col("n_parts") - 1), lambda i: F.substring(F.col("content"), i * chunk_bytes + 1, F.lit(chunk_bytes)))
    sized = objects.select("path", content.alias("content"), n_parts.alias("n_parts"))
    pieces = sized.select("path", "n_parts", F.length("content").cast("long").alias("length"), piece.alias("pieces"))
    whole = F.sha2(F.array_join(F.transform("pieces", lambda b: F.sha2(b, 256)), "").cast("binary"), 256)
    return pieces.select("path", "n_parts", "length", whole.alias("object_digest"), F.posexplode("pieces").alias("part", "bytes")).select(
        "path", "part", "n_parts", "length", "bytes", F.sha2("bytes", 256).alias("digest"), "object_digest")


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Store chunk rows, replacing an older table; objects need not fit a cell, only their chunks."""
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    chunks.select(*names).write.mode("overwrite").parquet(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunk rows stored by :func:`write_chunks`, each checked against its digest."""
    rows = spark.read.schema(CHUNKS).parquet(path)
    broken = F.raise_error(F.concat(F.lit("a chunk does not match its digest: "), "path", F.lit(" part "), F.col("part").cast("string")))
    return rows.withColumn("bytes", F.when(F.sha2("bytes", 256) == F.col("digest"), F.col("bytes")).otherwise(broken.cast("binary")))


def checked_chains(chunks: DataFrame) -> DataFrame:
    """``(path, length, n_parts, whole)`` of every object, without its bytes.

    ``whole`` says whether all parts are there once, in lengths and digests
    that agree with the object's own; it joins no bytes, so that objects
    beyond a cell can be checked.
    """
    parts = F.sort_array(F.collect_list(F.struct("part", "digest", F.length("bytes").cast("long").alias("size"))))
    found = chunks.groupBy("path").agg(
        parts.alias("parts"), F.max("length").alias("length"), F.max("n_parts").alias("n_parts"),
        F.max("object_digest").alias("object_digest"),
        F.countDistinct("length", "n_parts", "object_digest").alias("versions"))
    digest = F.sha2(F.array_join(F.transform("parts", lambda p: p["digest"]), "").cast("binary"), 256)
    whole = (
        (F.col("versions") == 1) & (F.size("parts") == F.col("n_parts"))
        & (F.transform("parts", lambda p: p["part"]) == F.sequence(F.lit(0), F.col("n_parts") - 1))
        & (F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["size"]) == F.col("length"))
        & (digest == F.col("object_digest")))
    return found.select("path", "length", "n_parts", whole.alias("whole"))


def join_chunks(chunks: DataFrame) -> DataFrame:
    """``(path, content)`` of objects that fit a cell, their chunks in order; a broken chain is refused."""
    refuse = F.raise_error(F.concat(F.lit("a broken chain of chunks: "), "path"))
    chains = checked_chains(chunks).select("path", F.when(F.col("whole"), F.lit(True)).otherwise(refuse.cast("boolean")).alias("whole"))
    parts = F.sort_array(F.collect_list(F.struct("part", "bytes")))
    joined = chunks.groupBy("path").agg(parts.alias("parts")).join(chains, "path").filter("whole")
    return joined.select("path", F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["bytes"])).alias("content"))
