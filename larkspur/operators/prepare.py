"""From raw string tables to clean, typed, scaled feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from larkspur.functions.cleaning import missing_to_null, to_float, to_id

ID, LABEL, FEATURES = "id", "label", "features"
ASSEMBLED = "assembled_features"


def feature_columns(columns: Sequence[str], id_col: str = ID, label_col: str = LABEL) -> list[str]:
    """Every column but id and label, in string order (``f10`` before ``f2``)."""
    return sorted(set(columns) - {id_col, label_col})


def type_columns(df: DataFrame, id_col: str = ID, columns: Sequence[str] | None = None) -> DataFrame:
    """``id`` as bigint, the rest as 32-bit floats; unreadable values become NULL."""
    chosen = [c for c in (columns or df.columns) if c != id_col]
    return df.select(_id_cell(df, id_col).alias(id_col), *_float_cells(df, chosen))


def _id_cell(df: DataFrame, id_col: str) -> Column:
    return to_id(F.col(id_col), isinstance(df.schema[id_col].dataType, T.StringType))


def _float_cells(df: DataFrame, columns: Sequence[str]) -> list:
    """Float columns as they are, by name; others cast."""
    types = {f.name: f.dataType for f in df.schema}
    return [c if isinstance(types[c], T.FloatType) else to_float(F.col(c)).alias(c) for c in columns]


def blank_missing(df: DataFrame) -> DataFrame:
    """NULL, NaN and blank text all become NULL, in every column."""
    return df.select(*(missing_to_null(F.col(f.name), f.dataType).alias(f.name) for f in df.schema))


def drop_missing(df: DataFrame) -> DataFrame:
    """Only the rows that have a value in every column."""
    texts = {f.name: missing_to_null(F.col(f.name), f.dataType)
             for f in df.schema if not isinstance(f.dataType, T.NumericType)}
    # ``na.drop`` itself treats NaN as missing, so numbers need no rewriting.
    return (df.withColumns(texts) if texts else df).na.drop("any")


def prepare(df: DataFrame, id_col: str = ID, columns: Sequence[str] | None = None) -> DataFrame:
    """Typed rows without missing values.

    Name the ``columns`` a job uses: others are pruned from the scan and
    cannot cost a row.
    """
    return drop_missing(type_columns(df, id_col, columns))


def split_rejects(df: DataFrame, id_col: str = ID,
                  columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean typed rows, and the raw rows that :func:`prepare` would drop."""
    chosen = [c for c in (columns or df.columns) if c != id_col]
    unreadable = F.exists(F.array(*_float_cells(df, chosen)), lambda v: v.isNull() | F.isnan(v))
    return prepare(df, id_col, columns), df.filter(_id_cell(df, id_col).isNull() | unreadable)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write rows once as Parquet and read them back.

    A written table spares later passes the work that made it and, unlike a
    cache, outlives lost executors.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_vectors(df: DataFrame, path: str, column: str, single: bool = True) -> DataFrame:
    """:func:`stage` for rows whose features stand in one vector column.

    Prepared values are 32-bit floats, so with ``single`` the vector is kept
    as a float array: half the bytes of a vector, and one column to decode
    instead of thousands.
    """
    packed = df.withColumn(column, vector_to_array(column, "float32" if single else "float64"))
    return stage(packed, path).withColumn(column, array_to_vector(F.col(column).cast("array<double>")))


def feature_stages(columns: Sequence[str], out: str = FEATURES) -> list:
    """Assemble ``columns`` into a vector and divide by the sample deviation.

    Values are not centred, so sparse vectors stay sparse.
    """
    return [
        VectorAssembler(inputCols=list(columns), outputCol=ASSEMBLED),
        StandardScaler(inputCol=ASSEMBLED, outputCol=out, withStd=True, withMean=False),
    ]


def assemble(df: DataFrame, columns: Sequence[str] | None = None, out: str = FEATURES) -> DataFrame:
    """All feature columns as one vector column."""
    return VectorAssembler(inputCols=list(columns or feature_columns(df.columns)), outputCol=out).transform(df)


def fit_scaling(df: DataFrame, columns: Sequence[str] | None = None) -> PipelineModel:
    """Learn the scaling from ``df``; reuse the result on every later table."""
    return Pipeline(stages=feature_stages(columns or feature_columns(df.columns))).fit(df)


def scale(df: DataFrame, scaling: PipelineModel | None = None) -> DataFrame:
    """``features`` scaled to unit sample deviation; a constant column gives 0.

    The scaled vector takes the name ``features`` and the unscaled one is gone.
    """
    model = scaling or fit_scaling(df)
    return model.transform(df).drop(ASSEMBLED)
