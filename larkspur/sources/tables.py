"""Tabular sources: headed CSV, libsvm, Parquet with a physical row key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Headed CSV from any Hadoop URI.

    Without ``schema`` the header is read and every column is a string.  With
    a schema the header peek is skipped and values are parsed while scanning;
    text that does not fit its type reads as NULL, and every file's header
    must name the schema's columns in its order.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.csv(path)
    # A file whose header names other columns, or in another order, fails instead of being read by position.
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_feature_csv(spark: SparkSession, path: str, id_col: str = "id") -> DataFrame:
    """Headed CSV with every column but the id parsed to a 32-bit float while scanning.

    Gives what :func:`read_csv` and a cast of each column would, without a
    string and a cast per value, which is what a wide table's time goes to.
    Text that is no number reads as NULL.  The id stays text.
    """
    names = read_csv(spark, path).columns
    return read_csv(spark, path, T.StructType(
        [T.StructField(n, T.StringType() if n == id_col else T.FloatType()) for n in names]))


def read_libsvm(spark: SparkSession, path: str, num_features: int) -> DataFrame:
    """Sparse labelled rows ``(label DOUBLE, features VECTOR)``.

    ``num_features`` is required: leaving it out costs a whole pass over the
    files just to find the largest index.
    """
    return spark.read.format("libsvm").option("numFeatures", str(num_features)).load(path)


def read_keyed_parquet(spark: SparkSession, path: str, key: str = "row_key") -> DataFrame:
    """Parquet rows with a unique key taken from their place in the files.

    File path plus row number in that file is unique, needs no shuffle, and is
    the same on every re-read, so it can drive the samplers for a table that
    has no key of its own.
    """
    place = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))
    return spark.read.parquet(path).withColumn(key, place)


def find_repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row, with their counts; empty when unique.

    Counts are combined before the shuffle, so a heavily repeated key is cheap.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
