"""The jobs a user runs: train, predict, select features, train on arrays.

Each takes a session from the caller, so a submitted job uses whatever
executors it was given.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from larkspur.operators import classify, evaluate, linear, sgd, wide
from larkspur.operators.prepare import ID, prepare, split_rejects
from larkspur.sources.arrays import read_arrays, write_arrays
from larkspur.sources.models import load_model, save_model, write_predictions
from larkspur.sources.tables import read_csv, read_feature_csv, read_libsvm

# Names and settings used when a job is given none.
DEFAULT_MODEL = "model"
DEFAULT_OUTPUT = "predict.csv"


def penalty_from_flags(ridge: bool, lasso: bool) -> str | None:
    """The penalty the two flags ask for; ridge wins when both are set."""
    return "ridge" if ridge else "lasso" if lasso else None


def train(spark: SparkSession, train_path: str, model_path: str = DEFAULT_MODEL,
          algorithm: str = "logistic", ridge: bool = False, lasso: bool = False,
          **settings) -> PipelineModel:
    """Read, prepare, fit and save; ``settings`` go to the fit."""
    if algorithm not in ("logistic", "forest"):
        raise ValueError(f"algorithm must be 'logistic' or 'forest', not {algorithm!r}")
    if algorithm == "forest" and (ridge or lasso):
        raise ValueError("a forest has no ridge or lasso penalty")
    rows = prepare(read_feature_csv(spark, train_path))
    if algorithm == "logistic":
        model = classify.fit_logistic(rows, penalty=penalty_from_flags(ridge, lasso), **settings)
    else:
        model = classify.fit_forest(rows, **settings)
    save_model(model, model_path)
    return model


def predict(spark: SparkSession, predict_path: str, model_path: str = DEFAULT_MODEL,
            output_path: str = DEFAULT_OUTPUT, rejects_path: str | None = None) -> None:
    """Score a table with a saved model and write ``id,prediction`` CSV files.

    Rows whose id or features cannot be read get no prediction; they are
    written to ``rejects_path``, as the text they were, when one is named.
    """
    model = load_model(model_path)
    write_predictions(classify.score(model, read_feature_csv(spark, predict_path)), output_path)
    if rejects_path is not None:
        raw = read_csv(spark, predict_path)
        write_predictions(split_rejects(raw, ID, classify.input_features(model))[1], rejects_path)


def run(spark: SparkSession, train_path: str | None = None, predict_path: str | None = None,
        model_path: str = DEFAULT_MODEL, output_path: str = DEFAULT_OUTPUT,
        algorithm: str = "logistic", ridge: bool = False, lasso: bool = False, **settings) -> None:
    """Train, predict, or both in that order, by which paths are given."""
    if train_path is not None:
        train(spark, train_path, model_path, algorithm, ridge, lasso, **settings)
    if predict_path is not None:
        predict(spark, predict_path, model_path, output_path)


def select_features(spark: SparkSession, path: str, max_iter: int = 10, reg_param: float = 0.1,
                    elastic_net_param: float = 1.0, parts: int | None = None) -> DataFrame:
    """Features of a table that survive an L1 penalty, with their weights."""
    rows = prepare(read_feature_csv(spark, path))
    return classify.select_features(rows, max_iter=max_iter, reg_param=reg_param,
                                    elastic_net_param=elastic_net_param, parts=parts)


def train_libsvm(spark: SparkSession, path: str, model_path: str, num_features: int,
                 estimator=None) -> PipelineModel:
    """Fit a classifier on a libsvm table of known width and save it.

    The model stays usable for its training summary.  The estimator is a
    logistic regression of 100 iterations unless one is given.
    """
    rows = read_libsvm(spark, path, num_features)
    model = classify.fit_vectors(rows, estimator or classify.logistic(max_iter=100))
    save_model(model, model_path)
    return model


def evaluate_libsvm(spark: SparkSession, path: str, model_path: str, num_features: int) -> DataFrame:
    """Accuracy of a saved model on a libsvm table."""
    return evaluate.accuracy(classify.evaluate_rows(load_model(model_path), read_libsvm(spark, path, num_features)))


def train_arrays(spark: SparkSession, path: str, model_path: str, key: str = "id",
                 settings: sgd.Settings = sgd.Settings(), rename: Mapping[str, str] | None = None) -> sgd.Trained:
    """Train the linear array model on the train part, test on the test part."""
    parts = [read_arrays(spark, path, part, key).withColumnsRenamed(dict(rename or {}))
             for part in ("train", "test")]
    trained = sgd.train(*parts, key=key, settings=settings)
    linear.save_weights(spark, trained.weights, model_path)
    return trained


def predict_arrays(spark: SparkSession, path: str, model_path: str, output_path: str,
                   key: str = "id", features: str = "features") -> None:
    """Score array rows with a saved linear model and write the classes."""
    weights = linear.load_weights(spark, model_path)
    write_arrays(linear.predict_arrays(read_arrays(spark, path), weights, key, features), output_path)


def benchmark(spark: SparkSession, train_rows: DataFrame, test_rows: DataFrame,
              configs: Iterable[Mapping], fit=classify.fit_logistic) -> DataFrame:
    """Wall time and accuracy of one fit and test per configuration.

    The rows are used as they are: stage them first, once for all configurations.
    """
    out = []
    for config in configs:
        began = time.perf_counter()
        model = fit(train_rows, staged=False, **config)
        fitted = time.perf_counter()
        result = evaluate.accuracy(classify.evaluate_rows(model, test_rows)).first()
        ended = time.perf_counter()
        out.append((", ".join(f"{k}={v}" for k, v in config.items()),
                    spark.sparkContext.defaultParallelism, result["rows"],
                    fitted - began, ended - fitted, result["accuracy"]))
    return spark.createDataFrame(
        out, "config STRING, slots INT, test_rows BIGINT, train_seconds DOUBLE, "
             "test_seconds DOUBLE, accuracy DOUBLE")


def task_cpu_seconds(spark: SparkSession) -> float:
    """CPU seconds of all tasks that this application has ended, from Spark's status store."""
    context = spark.sparkContext
    context._jsc.sc().listenerBus().waitUntilEmpty()
    nothing = context._jvm.java.util.ArrayList()
    stages = context._jsc.sc().statusStore().stageList(nothing, False, False, context._gateway.new_array(context._jvm.double, 0), nothing)
    return sum(stages.apply(i).executorCpuTime() for i in range(stages.size())) / 1e9


def benchmark_vectors(spark: SparkSession, train_rows: DataFrame, test_rows: DataFrame, expand: wide.Expand, width: int,
                      **settings) -> DataFrame:
    """One scaled logistic fit and test over staged rows: rows, seconds, CPU, rates and objective.

    Rows have ``label`` and the columns from which ``expand`` makes vectors of
    ``width`` numbers in every pass; nothing wide is kept.  ``values_per_second``
    counts training and test values over both times, ``cpu_seconds`` what the
    tasks' JVMs used meanwhile by Spark's own status store.
    """
    n_train, n_test = train_rows.count(), test_rows.count()
    used, began = task_cpu_seconds(spark), time.perf_counter()
    model = wide.fit(train_rows, expand, width, classify.logistic(**settings))
    fitted = time.perf_counter()
    accuracy = evaluate.accuracy(wide.evaluate_rows(model, test_rows, expand)).first()["accuracy"]
    ended, cpu = time.perf_counter(), task_cpu_seconds(spark) - used
    history = model.objective
    rises = sum(after > before + 1e-12 for before, after in zip(history, history[1:]))
    return spark.createDataFrame(
        [(n_train, n_test, width, spark.sparkContext.defaultParallelism, fitted - began, ended - fitted,
          (n_train + n_test) * width / (ended - began), cpu, float(accuracy), float(history[0]), float(history[-1]), rises)],
        "train_rows BIGINT, test_rows BIGINT, features INT, slots INT, train_seconds DOUBLE, test_seconds DOUBLE, "
        "values_per_second DOUBLE, cpu_seconds DOUBLE, accuracy DOUBLE, first_objective DOUBLE, last_objective DOUBLE, rises INT")
