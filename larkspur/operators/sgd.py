"""Mini-batch SGD for a linear softmax classifier, data-parallel on Spark.

Each epoch is ordered, sharded and batched by :mod:`larkspur.operators.sampling`
and written once, clustered by step, to the shared folder.  A large step reads
only its own rows: tasks turn them into partial gradients, these are summed,
and the driver updates its small matrix.  Small steps wait for each other, so a
bounded run of them is one task, which streams its rows in order of the steps
and hands weights and velocity to the next.  Rows never pass through the driver,
and a lost executor costs a re-read of the written steps, not of the whole epoch.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from larkspur.operators.linear import matrix_reader, zero_weights
from larkspur.operators.sampling import epoch_batches
from larkspur.operators.schedule import plateau_tracker
from larkspur.sources.shared import work_path

# With more slots than this squared, tasks' vectors are added in groups first.
WIDE = 8
# Bytes of features in a block of steps, and in a run of steps that one task takes.
BLOCK_BYTES, RUN_BYTES = 256 << 20, 32 << 20
HISTORY_SCHEMA = ("epoch INT, batch INT, batch_rows BIGINT, n_batches INT, n_rows BIGINT, "
                  "loss DOUBLE")
EPOCHS_SCHEMA = "epoch INT, lr DOUBLE, test_loss DOUBLE, accuracy DOUBLE"


@dataclass(frozen=True)
class Settings:
    """How to train; the defaults are the job's customary ones."""

    n_classes: int = 10
    epochs: int = 10
    batch_size: int = 128
    world: int = 1
    lr: float = 0.02
    momentum: float = 0.9
    weight_decay: float = 1e-4
    seed: int = 0
    patience: int = 2
    target_accuracy: float = 0.8
    steps_per_block: int | None = None
    digits: int | None = None


@dataclass
class Trained:
    """Final weights with one history row per step and one per epoch."""

    weights: np.ndarray
    steps: list = field(default_factory=list)
    epochs: list = field(default_factory=list)

    def history(self, spark) -> DataFrame:
        return spark.createDataFrame(self.steps, HISTORY_SCHEMA)

    def epoch_summary(self, spark) -> DataFrame:
        return spark.createDataFrame(self.epochs, EPOCHS_SCHEMA)


def _linear_pass(n_classes: int, n_features: int):
    """Functions that read an Arrow batch, score rows, and sum their gradient and losses.

    Returned as closures so that tasks need no copy of this package.
    """
    to_matrix = matrix_reader(n_features)

    def read(batch):
        x = to_matrix(batch.column("features"))
        y = batch.column("label").to_numpy(zero_copy_only=False)
        if y.dtype.kind != "i" or y.min() < 0 or y.max() >= n_classes:
            raise ValueError(f"labels must be whole numbers from 0 to {n_classes - 1}")
        return x, y

    def forward(weights, x, y):
        """Shifted scores, their mass and losses."""
        logits = x @ weights[:, :-1].T + weights[:, -1]
        logits -= logits.max(axis=1, keepdims=True)
        mass = np.exp(logits).sum(axis=1)
        return logits, mass, np.log(mass) - logits[np.arange(len(y)), y]

    def gradient(weights, x, y):
        logits, mass, losses = forward(weights, x, y)
        pull = np.exp(logits) / mass[:, None]
        pull[np.arange(len(y)), y] -= 1.0
        return np.hstack([pull.T @ x, pull.sum(axis=0)[:, None]]), float(losses.sum())

    return read, forward, gradient


def _labelled(rows: DataFrame) -> DataFrame:
    return rows.select("features", F.col("label").cast("int").alias("label"))


def summed(tasks: DataFrame, slots: int) -> DataFrame:
    """``(total, n)`` of tasks' ``part`` vectors; on many slots they are added in groups first."""
    groups = math.isqrt(slots)
    if groups > WIDE:
        tasks = tasks.groupBy((F.spark_partition_id() % groups).alias("group")).agg(Summarizer.sum(F.col("part")).alias("part"))
    return tasks.agg(Summarizer.sum(F.col("part")).alias("total"), F.count(F.lit(1)).alias("n"))


def batch_sums(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, float, int]:
    """Summed softmax gradient, summed loss and row count of ``(features, label)`` rows.

    Each task gives one vector; the JVM adds them up, in two levels where
    tasks are many, and the driver gets one number per weight.
    """
    n_classes, width = weights.shape
    read, _, gradient = _linear_pass(n_classes, width - 1)

    def partial(record_batches):
        grad, loss, count = np.zeros((n_classes, width)), 0.0, 0
        for batch in record_batches:
            if not batch.num_rows:
                continue
            x, y = read(batch)
            pull, lost = gradient(weights, x, y)
            grad += pull
            loss += lost
            count += len(y)
        if count:
            values = np.concatenate([grad.ravel(), [loss, count]])
            yield pa.RecordBatch.from_arrays([pa.array([values], pa.list_(pa.float64()))], ["part"])

    tasks = _labelled(rows).mapInArrow(partial, "part ARRAY<DOUBLE>").withColumn("part", array_to_vector("part"))
    row = summed(tasks, rows.sparkSession.sparkContext.defaultParallelism).first()
    if not row["n"]:
        return np.zeros((n_classes, width)), 0.0, 0
    total = row["total"].toArray()
    return total[:-2].reshape(n_classes, width), float(total[-2]), int(total[-1])


def evaluation(rows: DataFrame, weights: np.ndarray) -> tuple[float, float]:
    """Mean loss and accuracy over every row of a test table."""
    read, forward, _ = _linear_pass(len(weights), weights.shape[1] - 1)

    def partial(record_batches):
        for batch in record_batches:
            if not batch.num_rows:
                continue
            x, y = read(batch)
            logits, _, losses = forward(weights, x, y)
            hits = int((logits.argmax(axis=1) == y).sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(losses.sum())]), pa.array([hits]), pa.array([len(y)])], ["loss", "hits", "n"])

    total = (
        _labelled(rows).mapInArrow(partial, "loss DOUBLE, hits BIGINT, n BIGINT")
        .agg(F.sum("loss").alias("loss"), F.sum("hits").alias("hits"), F.sum("n").alias("n")).first()
    )
    if not total["n"]:
        raise ValueError("the test table is empty")
    return total["loss"] / total["n"], total["hits"] / total["n"]


def _nesterov(momentum: float, weight_decay: float):
    """Nesterov momentum without dampening; decay applies to every weight.  A closure, for tasks too."""
    def update(weights, velocity, mean_gradient, lr):
        pull = mean_gradient + weight_decay * weights
        velocity = pull if velocity is None else momentum * velocity + pull
        return weights - lr * (pull + momentum * velocity), velocity

    return update


class Momentum:
    """The optimizer of a run: its rule and its velocity."""

    def __init__(self, momentum: float, weight_decay: float):
        self.momentum, self.weight_decay = momentum, weight_decay
        self.velocity = None

    def step(self, weights: np.ndarray, mean_gradient: np.ndarray, lr: float) -> np.ndarray:
        weights, self.velocity = _nesterov(self.momentum, self.weight_decay)(weights, self.velocity, mean_gradient, lr)
        return weights


def run_steps(rows: DataFrame, weights: np.ndarray, optimizer: Momentum, lr: float) -> tuple[np.ndarray, list[tuple]]:
    """Take the steps of ``(step, features, label)`` rows one after another, in one task.

    Gives the weights after the last and ``(step, rows, summed loss)`` of each;
    ``optimizer`` keeps the velocity.  The rows stream through the task in order
    of their steps, so name no more than a bounded run of small steps: each
    waits for the one before it, and a job for each would cost far more than
    its arithmetic.
    """
    n_classes, width = weights.shape
    read, _, gradient = _linear_pass(n_classes, width - 1)
    update, velocity = _nesterov(optimizer.momentum, optimizer.weight_decay), optimizer.velocity

    def run(record_batches):
        now, speed, done = weights, velocity, []
        current, grad, loss, count = None, None, 0.0, 0

        def advance():
            nonlocal now, speed
            if current is not None:
                now, speed = update(now, speed, grad / count, lr)
                done.append((current, count, loss))

        for batch in record_batches:
            if not batch.num_rows:
                continue
            x, y = read(batch)
            steps = batch.column("step").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(steps)) + 1).tolist(), len(steps)]
            for low, high in zip(cuts, cuts[1:]):
                if steps[low] != current:
                    advance()
                    current, grad, loss, count = int(steps[low]), np.zeros((n_classes, width)), 0.0, 0
                pull, lost = gradient(now, x[low:high], y[low:high])
                grad, loss, count = grad + pull, loss + lost, count + high - low
        advance()
        if done:
            columns = [now.ravel(), speed.ravel(), *map(list, zip(*done))]
            kinds = [pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.list_(k)) for c, k in zip(columns, kinds)],
                                             ["weights", "velocity", "steps", "counts", "losses"])

    found = rows.select("step", "features", F.col("label").cast("int").alias("label")).coalesce(1).sortWithinPartitions("step").mapInArrow(
        run, "weights ARRAY<DOUBLE>, velocity ARRAY<DOUBLE>, steps ARRAY<BIGINT>, counts ARRAY<BIGINT>, losses ARRAY<DOUBLE>").first()
    if found is None:
        return weights, []
    optimizer.velocity = np.array(found["velocity"]).reshape(weights.shape)
    return np.array(found["weights"]).reshape(weights.shape), list(zip(found["steps"], found["counts"], found["losses"]))


def block_steps(settings: Settings, width: int) -> int:
    """Steps in one directory: as many as settings say, or as hold some ``BLOCK_BYTES`` of features."""
    if settings.steps_per_block:
        return settings.steps_per_block
    return max(1, BLOCK_BYTES // _step_bytes(settings, width))


def run_length(settings: Settings, width: int) -> int:
    """Steps that one task takes: as many as ``RUN_BYTES`` of features hold, within a block; 1 if steps are too large to share."""
    return max(1, min(RUN_BYTES // _step_bytes(settings, width), block_steps(settings, width)))


def _step_bytes(settings: Settings, width: int) -> int:
    return settings.world * settings.batch_size * 4 * width


def write_epoch(df: DataFrame, key: str, epoch: int, settings: Settings, path: str, width: int, together: int = 1) -> None:
    """Write one epoch's rows clustered by step.

    A step is the same batch number on every rank.  Steps are gathered into
    directories, so reading one opens few files, and a file keeps them in row
    groups of about its share of the ``together`` steps that are read at a time,
    of which their filter skips the others.  The next epoch replaces this one: only a single copy of the data
    exists.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    group = max(4096, together * _step_bytes(settings, width) // slots)
    rows = epoch_batches(df, key, settings.seed, epoch, settings.world, settings.batch_size,
                         digits=settings.digits)
    placed = rows.select(
        F.col("batch").cast("int").alias("step"), "features", F.col("label").cast("int").alias("label"),
        F.expr(f"cast(batch div {block_steps(settings, width)} as int)").alias("block"))
    (placed.sortWithinPartitions("block", "step").write.mode("overwrite")
     .option("parquet.block.size", group).option("parquet.page.size.row.check.min", 10).partitionBy("block").parquet(path))


def train(df: DataFrame, test: DataFrame, key: str, settings: Settings = Settings(),
          weights: np.ndarray | None = None) -> Trained:
    """Train on ``(key, features, label)`` rows, testing after each epoch.

    The gradient of a step is the mean over the batches of all ranks, which
    are of one size, so it equals averaging the ranks' own mean gradients.
    """
    spark = df.sparkSession
    rows = df.select(key, "features", "label")
    n_rows = rows.count()
    if not n_rows:
        raise ValueError("the training table is empty")
    if weights is None:
        weights = zero_weights(settings.n_classes, len(rows.first()["features"]))
    rows_per_rank = math.ceil(n_rows / settings.world)
    n_steps = math.ceil(rows_per_rank / settings.batch_size)
    optimizer = Momentum(settings.momentum, settings.weight_decay)
    advance = plateau_tracker(settings.patience)
    lr_state = (settings.lr, float("inf"), 0)
    result = Trained(weights)
    path, width = work_path(spark, "epoch"), result.weights.shape[1]
    per_block, together = block_steps(settings, width), run_length(settings, width)
    step_schema = f"step INT, features {rows.schema['features'].dataType.simpleString()}, label INT"
    for epoch in range(1, settings.epochs + 1):
        write_epoch(rows, key, epoch, settings, path, width, together)
        for first in range(0, n_steps, per_block):
            block = spark.read.schema(step_schema).parquet(f"{path}/block={first // per_block}")
            for low in range(first, min(first + per_block, n_steps), together):
                high = min(low + together, first + per_block, n_steps)
                wanted = block.filter((F.col("step") >= low) & (F.col("step") < high))
                if together > 1:
                    result.weights, taken = run_steps(wanted, result.weights, optimizer, lr_state[0])
                else:
                    grad, loss, count = batch_sums(wanted, result.weights)
                    result.weights = optimizer.step(result.weights, grad / count, lr_state[0])
                    taken = [(low, count, loss)]
                result.steps += [(epoch, step, count, n_steps, n_rows, loss / count) for step, count, loss in taken]
        test_loss, accuracy = evaluation(test, result.weights)
        result.epochs.append((epoch, lr_state[0], test_loss, accuracy))
        lr_state = advance(lr_state, test_loss)
        if accuracy >= settings.target_accuracy:
            break
    return result
