"""Learning-rate reduction on a plateau, early stop, and the training log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from larkspur.operators.prepare import stage
from larkspur.sources.shared import work_path

# The schedule's customary settings.
PLATEAU = {"factor": 0.1, "threshold": 1e-4, "smallest_change": 1e-8}


def plateau_tracker(patience: int = 2, factor: float = PLATEAU["factor"],
                    threshold: float = PLATEAU["threshold"]):
    """A function ``(state, loss) -> state`` over ``(lr, best, bad_epochs)``.

    An epoch is bad unless its loss beats the best one by the relative
    threshold; after more than ``patience`` bad epochs in a row the rate is
    multiplied by ``factor`` and the count restarts.  A closure, so it travels
    to tasks by itself.
    """
    smallest_change = PLATEAU["smallest_change"]

    def advance(state, loss):
        lr, best, bad = state
        if loss < best * (1.0 - threshold):
            return lr, loss, 0
        if bad < patience:
            return lr, best, bad + 1
        lower = lr * factor
        return (lower if lr - lower > smallest_change else lr), best, 0

    return advance


def plateau_rates(history: DataFrame, lr: float = 0.02, patience: int = 2,
                  factor: float = PLATEAU["factor"], threshold: float = PLATEAU["threshold"],
                  part_epochs: int = 1_000_000, fold_events: int = 1_000_000) -> DataFrame:
    """Rate in force after each epoch, for many runs at once.

    ``history`` is ``(run_id BIGINT, epoch BIGINT, loss DOUBLE)``, with unique
    epochs in any increasing numbering; losses may have any sign, and a NULL or
    NaN loss is never an improvement.

    An epoch's state follows from the last improvement before it: the number
    of epochs since then gives bad epochs and reductions by whole division.
    A loss that beats the lowest one before it by the threshold is an
    improvement whatever came between, which a window sees.  Other improvements
    (small steps down, or drifts of negative losses) depend on those since the
    last such loss, and are found by folding the few candidates between two of
    them.  Runs are cut into parts of ``part_epochs`` epoch numbers, side by
    side; only a stretch of more than ``fold_events`` candidates is folded in
    turns, one job each.
    """
    rows = history.select(
        F.col("run_id").cast("bigint"), F.col("epoch").cast("bigint"),
        F.nanvl(F.col("loss").cast("double"), F.lit(None).cast("double")).alias("loss"),
        F.expr(f"cast(epoch AS BIGINT) div {int(part_epochs)}").alias("part"))
    span = rows.groupBy("run_id").agg((F.max("part") - F.min("part")).alias("span")).agg(F.max("span")).first()[0]
    if span:
        rows = stage(rows, work_path(history.sparkSession, "losses"))
    parts = _parts(rows) if span else None
    events = _events(rows, parts, threshold)
    if span:
        events = stage(_anchored(events), work_path(history.sparkSession, "events"))
    better = events.filter("sure").select(*_EVENT).unionByName(_folded(events, threshold, fold_events if span else None))
    return _states(rows, *_marks(better, parts, patience), lr, patience, factor)


_EVENT = ("run_id", "part", "epoch", "place", "loss")


def _parts(rows: DataFrame) -> DataFrame:
    """``(run_id, part, place, low)``: epochs and lowest loss of the run before each part."""
    earlier = Window.partitionBy("run_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy("run_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("loss").alias("least"))
        .select("run_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("place"),
                F.min("least").over(earlier).alias("low")))


def _events(rows: DataFrame, parts: DataFrame | None, threshold: float) -> DataFrame:
    """Epochs that are, or may be, improvements, with their place in the run.

    ``anchor`` is the place and loss of the last sure one up to here, in this part.
    """
    if parts is None:
        rows = rows.withColumns({"place": F.lit(0), "low": F.lit(None).cast("double")})
    else:
        rows = rows.join(parts, ["run_id", "part"])
    in_part = Window.partitionBy("run_id", "part").orderBy("epoch")
    before = in_part.rowsBetween(Window.unboundedPreceding, -1)
    low, loss = F.col("low"), F.col("loss")
    placed = rows.select("run_id", "part", "epoch", "loss", (F.col("place") + F.row_number().over(in_part)).alias("place"),
                         F.coalesce(F.least("low", F.min("loss").over(before)), F.lit(float("inf"))).alias("low"))
    # Negative losses: the best one may drift up, so that any of them can be an improvement.
    possible = F.when(low >= 0, loss < low).otherwise((loss < 0) & (low > float("-inf")))
    marked = placed.withColumn("sure", F.coalesce(loss < low * (1.0 - threshold), F.lit(False))).filter(
        F.col("sure") | F.coalesce(possible, F.lit(False))).drop("low")
    so_far = in_part.rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("anchor", F.last(F.when(F.col("sure"), F.struct("place", "loss")), ignorenulls=True).over(so_far))


def _anchored(events: DataFrame) -> DataFrame:
    """Events with the anchors of earlier parts where their own part has none before them."""
    earlier = Window.partitionBy("run_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    last = events.groupBy("run_id", "part").agg(F.max(F.when(F.col("sure"), F.struct("place", "loss"))).alias("last"))
    carried = last.select("run_id", "part", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    return events.join(carried, ["run_id", "part"]).withColumn("anchor", F.coalesce("anchor", "carried")).drop("carried")


def _fold(best: Column, candidates: Column, threshold: float) -> Column:
    """The candidates that improve on ``best`` and on each other, in order, and the best loss after them."""
    kind = "array<struct<place: bigint, epoch: bigint, part: bigint, loss: double>>"

    def state(best: Column, found: Column) -> Column:
        return F.struct(best.alias("best"), found.alias("found"))

    def take(so_far: Column, candidate: Column) -> Column:
        better = candidate["loss"] < so_far["best"] * (1.0 - threshold)
        return F.when(better, state(candidate["loss"], F.concat(so_far["found"], F.array(candidate)))).otherwise(so_far)

    def take_slice(so_far: Column, number: Column) -> Column:
        # Slices keep the lists that grow by one short.
        inner = F.aggregate(F.slice(candidates, number * _FOLDED + 1, F.lit(_FOLDED)), state(so_far["best"], F.array().cast(kind)), take)
        return F.aggregate(F.array(inner), so_far, lambda old, new: state(new["best"], F.concat(old["found"], F.array(new["found"]))))

    numbers = F.sequence(F.lit(0), F.floor(F.size(candidates) / _FOLDED).cast("int"))
    folded = F.aggregate(numbers, state(best, F.array().cast(f"array<{kind}>")), take_slice)
    return F.struct(folded["best"].alias("best"), F.flatten(folded["found"]).alias("found"))


_FOLDED = 1000


def _folded(events: DataFrame, threshold: float, fold_events: int | None) -> DataFrame:
    """Improvements among the events that are not sure, from the last sure one before them.

    Without ``fold_events`` a stretch lies in one part and is folded at once.
    """
    candidates = F.sort_array(F.collect_list(F.struct("place", "epoch", "part", "loss"))).alias("candidates")
    unsure = events.filter(~F.col("sure")).select("run_id", "anchor", "place", "epoch", "part", "loss")

    def found(folded: DataFrame) -> DataFrame:
        return folded.select("run_id", F.explode("fold.found").alias("x")).select("run_id", "x.part", "x.epoch", "x.place", "x.loss")

    if not fold_events:
        groups = unsure.groupBy("run_id", "anchor").agg(candidates)
        return found(groups.withColumn("fold", _fold(F.col("anchor.loss"), F.col("candidates"), threshold)))
    # Long stretches: whole parts of some fold_events candidates at a time, with the best loss so far.
    spark = events.sparkSession
    before = Window.partitionBy("run_id", "anchor").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    turns = unsure.groupBy("run_id", "anchor", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "run_id", "anchor", "part", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / fold_events).alias("turn"))
    groups = unsure.join(turns, ["run_id", "anchor", "part"]).groupBy("run_id", "anchor", "turn").agg(candidates)
    groups = stage(groups, work_path(spark, "stretches"))
    state = groups.filter("turn = 0").select("run_id", "anchor", F.col("anchor.loss").alias("best"))
    every = [found(groups.limit(0).withColumn("fold", _fold(F.col("anchor.loss"), F.col("candidates"), threshold)))]
    for row in groups.select("turn").distinct().orderBy("turn").collect():
        # A stretch without candidates for this turn keeps its best loss.
        folded = groups.filter(F.col("turn") == row["turn"]).join(state, ["run_id", "anchor"], "right").withColumn(
            "fold", _fold(F.col("best"), F.coalesce("candidates", F.array().cast(groups.schema["candidates"].dataType)), threshold)).select(
            "run_id", "anchor", "fold")
        folded = stage(folded, work_path(spark, "folded"))
        every.append(found(folded))
        state = folded.select("run_id", "anchor", F.col("fold.best").alias("best"))
    return reduce(DataFrame.unionByName, every)


def _marks(better: DataFrame, parts: DataFrame | None, patience: int) -> tuple[DataFrame | None, DataFrame]:
    """State before each part (None: every run starts in its only one) and after each improvement."""

    def cuts(place: Column, since: Column) -> Column:
        return F.floor((place - since - 1) / (patience + 1))

    in_part = Window.partitionBy("run_id", "part").orderBy("place")
    gapped = better.withColumn("gap", cuts(F.col("place"), F.lag("place").over(in_part)))
    if parts is None:
        entries, entered = None, gapped.withColumns({"entry_since": F.lit(0), "entry_cuts": F.lit(0)})
    else:
        earlier = Window.partitionBy("run_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        own = gapped.groupBy("run_id", "part").agg(
            F.min("place").alias("first"), F.max(F.struct("place", "loss")).alias("last"), F.coalesce(F.sum("gap"), F.lit(0)).alias("inside"))
        carried = parts.select("run_id", "part", "place").join(own, ["run_id", "part"], "left").withColumn(
            "entry", F.last("last", ignorenulls=True).over(earlier))
        since = F.coalesce("entry.place", F.lit(0))
        total = F.coalesce(F.col("inside") + cuts(F.col("first"), since), F.lit(0))
        entries = carried.withColumn("total", total).select(
            "run_id", "part", "place", F.coalesce("entry.loss", F.lit(float("inf"))).alias("best_loss"), since.alias("since"),
            F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("cuts"))
        entered = gapped.join(entries.select("run_id", "part", F.col("since").alias("entry_since"), F.col("cuts").alias("entry_cuts")),
                              ["run_id", "part"])
    so_far = in_part.rowsBetween(Window.unboundedPreceding, 0)
    gap = F.coalesce("gap", cuts(F.col("place"), F.col("entry_since")))
    return entries, entered.select("run_id", "part", "epoch", F.col("loss").alias("best_loss"), F.col("place").alias("since"),
                                   (F.col("entry_cuts") + F.sum(gap).over(so_far)).alias("cuts"))


def _states(rows: DataFrame, entries: DataFrame | None, better: DataFrame, lr: float, patience: int, factor: float) -> DataFrame:
    """Every epoch's state, from the last improvement before it, with built-in functions alone."""
    smallest_change, rates = PLATEAU["smallest_change"], [lr]
    while rates[-1] - rates[-1] * factor > smallest_change:
        rates.append(rates[-1] * factor)
    state = F.struct("best_loss", "since", "cuts").alias("state")
    start = F.struct(F.lit(float("inf")).alias("best_loss"), F.lit(0).cast("bigint").alias("since"), F.lit(0).cast("bigint").alias("cuts"))
    none = F.lit(None)
    marks = better.select("run_id", "part", "epoch", none.cast("bigint").alias("place"), state)
    if entries is not None:
        marks = marks.unionByName(entries.select("run_id", "part", none.cast("bigint").alias("epoch"), "place", state))
    both = marks.withColumn("is_row", F.lit(0)).unionByName(
        rows.select("run_id", "part", "epoch", F.lit(1).alias("is_row")), allowMissingColumns=True)
    # A part's entry comes first, an improvement's mark just before its own epoch.
    so_far = Window.partitionBy("run_id", "part").orderBy(F.col("epoch").asc_nulls_first(), "is_row").rowsBetween(
        Window.unboundedPreceding, 0)
    placed = both.select(
        "run_id", "epoch", "is_row", F.coalesce(F.last("state", ignorenulls=True).over(so_far), start).alias("state"),
        (F.coalesce(F.last("place", ignorenulls=True).over(so_far), F.lit(0)) + F.sum("is_row").over(so_far)).alias("place")
    ).filter("is_row = 1")
    since = F.col("place") - F.col("state.since")
    reached = F.col("state.cuts") + F.floor(since / (patience + 1))
    return placed.select(
        "run_id", "epoch", F.element_at(F.array(*map(F.lit, rates)), F.least(reached + 1, F.lit(len(rates))).cast("int")).alias("lr"),
        F.col("state.best_loss").alias("best_loss"), (since % (patience + 1)).cast("int").alias("bad_epochs"))


def stop_epochs(history: DataFrame, target: float = 0.8) -> DataFrame:
    """First epoch of each run whose accuracy reaches the target."""
    return (history.filter(F.col("accuracy") >= target)
            .groupBy("run_id").agg(F.min("epoch").alias("stop_epoch")))


def training_log(history: DataFrame, interval: int = 10, *tags: str) -> DataFrame:
    """Every ``interval``-th batch of a loss history, with the epoch's progress.

    ``history`` is ``(epoch, batch, batch_rows, n_batches, n_rows, loss)`` and
    any ``tags``, such as the rank a batch belongs to.
    """
    return history.filter(F.col("batch") % interval == 0).select(
        "epoch", *tags, "batch",
        (F.col("batch") * F.col("batch_rows")).alias("rows_seen"),
        "n_rows",
        (100.0 * F.col("batch") / F.col("n_batches")).alias("progress"),
        "loss",
    )
