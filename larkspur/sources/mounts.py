"""File systems that a session reaches by names of its own."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def mount(spark: SparkSession, name: str, links: Mapping[str, str]) -> str:
    """Bind folders to places under ``viewfs://name`` by Hadoop's mount table, for this session's jobs.

    ``links`` maps each place (``/data``) to the URI of its folder, on any file
    system the cluster reaches.  Returns the root; every reader and writer of
    this package takes paths under it.
    """
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    for place, target in links.items():
        if not place.startswith("/"):
            raise ValueError(f"a place starts with a slash, not {place!r}")
        settings.set(f"fs.viewfs.mounttable.{name}.link.{place}", target if ":" in target else f"file:{target}")
    return f"viewfs://{name}"
