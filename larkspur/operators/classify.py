"""Logistic regression and random forest: fit, explain, select, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from larkspur.functions.cleaning import to_binary_label
from larkspur.operators.prepare import (
    ASSEMBLED, FEATURES, ID, LABEL, feature_columns, feature_stages, prepare, stage_vectors,
)
from larkspur.operators.slices import deal_rows, planned_slices
from larkspur.sources.shared import delete_work, work_path

# Penalty names and the share of L1 in each.
PENALTIES = {"ridge": 0.0, "lasso": 1.0}


def penalty_mix(penalty: str | None, reg_param: float) -> float:
    """The L1 share for a penalty name.

    A named penalty without a positive strength would change nothing, so it
    is refused instead of being silently ignored.
    """
    if penalty is None:
        return 0.0
    if penalty not in PENALTIES:
        raise ValueError(f"penalty must be one of {sorted(PENALTIES)} or None, not {penalty!r}")
    if not reg_param > 0.0:
        raise ValueError(f"penalty {penalty!r} needs reg_param > 0")
    return PENALTIES[penalty]


def logistic(label: str = LABEL, max_iter: int = 10, penalty: str | None = None,
             reg_param: float = 0.0, elastic_net_param: float | None = None,
             tol: float = 1e-6) -> LogisticRegression:
    """An unfitted logistic regression, binary or multinomial by its labels."""
    mix = penalty_mix(penalty, reg_param) if elastic_net_param is None else elastic_net_param
    return LogisticRegression(featuresCol=FEATURES, labelCol=label, maxIter=int(max_iter),
                              regParam=reg_param, elasticNetParam=mix, tol=tol)


def forest(label: str = LABEL, num_trees: int = 20, max_depth: int = 5, seed: int = 0,
           bootstrap: bool = True, feature_subset: str = "auto", max_bins: int = 32,
           min_instances: int = 1, subsampling: float = 1.0) -> RandomForestClassifier:
    """An unfitted random forest; one seed, one forest for rows in a fixed order."""
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=label, numTrees=num_trees,
                                  maxDepth=max_depth, seed=seed, bootstrap=bootstrap,
                                  featureSubsetStrategy=feature_subset, maxBins=max_bins,
                                  minInstancesPerNode=min_instances, subsamplingRate=subsampling)


def fit_logistic(df: DataFrame, features: Sequence[str] | None = None, label: str = LABEL,
                 staged: bool = True, parts: int | None = None, **settings) -> PipelineModel:
    """Assemble, scale and fit a logistic regression; ``settings`` as in :func:`logistic`.

    ``df`` holds prepared rows.  The fitted scaling is part of the model, so
    new rows are scaled as the training rows were, not by their own spread.
    With ``staged`` the assembled rows are written once to the shared folder
    and dealt by content into ``parts`` slices, which the size of that table
    decides unless it is named; every pass of the fit reads the slices, and
    the table is deleted when the fit ends.
    """
    return _fit(df, features, label, logistic(label, **settings), staged, parts, ordered=False)


def fit_forest(df: DataFrame, features: Sequence[str] | None = None, label: str = LABEL,
               staged: bool = True, parts: int | None = None, **settings) -> PipelineModel:
    """Assemble, scale and fit a random forest; ``settings`` as in :func:`forest`.

    Rows are dealt into ``parts`` slices by their content and sorted, so that a
    seed draws the same rows, and grows the same forest, on any cluster and
    from any number of files.
    """
    return _fit(df, features, label, forest(label, **settings), staged, parts, ordered=True)


def _fit(df, features, label, estimator, staged, parts, ordered) -> PipelineModel:
    columns = list(features or feature_columns(df.columns, label_col=label))
    assembler, scaler = feature_stages(columns)
    rows = assembler.transform(df.select(label, *columns)).select(label, ASSEMBLED)
    single = all(isinstance(df.schema[c].dataType, T.FloatType) for c in columns)
    path = work_path(df.sparkSession, "assembled")
    try:
        if staged:
            rows = stage_vectors(rows, path, ASSEMBLED, single)
        if staged or ordered:
            n = parts or planned_slices(rows.count(), 8 + len(columns) * (4 if single else 8))
            # Kept for the passes of the fit; what an executor loses is dealt again from the staged table.
            rows = deal_rows(rows, n, label, ASSEMBLED).persist(StorageLevel.MEMORY_AND_DISK)
        scaling = scaler.fit(rows)
        fitted = estimator.fit(scaling.transform(rows))
    finally:
        rows.unpersist()
        delete_work(df.sparkSession, path)
    return PipelineModel(stages=[assembler, scaling, fitted])


def fit_vectors(df: DataFrame, estimator: LogisticRegression | RandomForestClassifier) -> PipelineModel:
    """Fit on ``(label, features VECTOR)`` rows, as libsvm gives them, without scaling.

    Labels coded -1/1 are taken as 0/1.
    """
    rows = df.withColumn(LABEL, to_binary_label(F.col(LABEL)))
    return PipelineModel(stages=[estimator.fit(rows)])


def input_features(model: PipelineModel) -> list[str]:
    """The feature columns a fitted model reads, in vector order."""
    return model.stages[0].getInputCols()


def score(model: PipelineModel, raw: DataFrame, id_col: str = ID,
          with_probability: bool = False) -> DataFrame:
    """``(id, prediction)`` for every raw row whose id and features can be read.

    Columns the model does not use, a label among them, are never looked at,
    so they cannot drop a row; :func:`larkspur.operators.prepare.split_rejects`
    lists the rows that are.
    """
    rows = prepare(raw, id_col, input_features(model))
    return project_predictions(model.transform(rows), id_col, with_probability)


def project_predictions(scored: DataFrame, id_col: str = ID, with_probability: bool = False) -> DataFrame:
    """Id and whole-number class; on request the class probabilities too."""
    out = [F.col(id_col), F.col("prediction").cast("int").alias("prediction")]
    if with_probability:
        out.append(vector_to_array("probability").alias("probability"))
    return scored.select(*out)


def evaluate_rows(model: PipelineModel, prepared: DataFrame, label: str = LABEL) -> DataFrame:
    """``(label, prediction)`` of prepared rows, for the evaluation operators."""
    return model.transform(prepared).select(to_binary_label(F.col(label)).alias("label"), "prediction")


def coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(feature, coefficient, raw_coefficient)`` of a binary logistic model.

    ``coefficient`` belongs to the scaled feature; ``raw_coefficient`` is the
    same effect per unit of the unscaled one.
    """
    names = input_features(model)
    stds = model.stages[1].std.toArray()
    values = model.stages[-1].coefficients.toArray()
    rows = [(n, float(v), float(v / s) if s > 0 else 0.0) for n, v, s in zip(names, values, stds)]
    return spark.createDataFrame(rows, "feature STRING, coefficient DOUBLE, raw_coefficient DOUBLE")


def select_features(df: DataFrame, features: Sequence[str] | None = None, label: str = LABEL,
                    max_iter: int = 10, reg_param: float = 0.1, elastic_net_param: float = 1.0,
                    staged: bool = True, parts: int | None = None) -> DataFrame:
    """Features that keep a non-zero coefficient under an L1 penalty."""
    if int(max_iter) != max_iter:
        raise ValueError("max_iter must be a whole number")
    model = fit_logistic(df, features, label, staged, parts, max_iter=max_iter, reg_param=reg_param,
                         elastic_net_param=elastic_net_param)
    return coefficients(df.sparkSession, model).filter("coefficient <> 0")


def training_history(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(iteration, objective)`` of a logistic model fitted in this session."""
    history = model.stages[-1].summary.objectiveHistory
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(history)],
                                 "iteration INT, objective DOUBLE")

