"""Splits of samples in time, choice of candidates, and ledgers of what was tried and opened.

Samples have the columns sample_id, observation_time, decision_time, label_start, label_end and
label_available. A split is one row for every sample and fold with its role: train, validation,
test, purged or embargoed.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators.pit import guard
from tidemark.operators.windows import session_index


def fold_blocks(samples: DataFrame, folds: int, time: str = "observation_time", by: Sequence[str] = ()) -> DataFrame:
    """``fold`` from 1, within each ``by``: consecutive blocks in order of time, the first ones a row longer where uneven.

    A sample's place is the number of samples on earlier days, a running sum with one row a day, and
    its place among those of its own day; no task sorts more than a day.
    """
    if folds < 2:
        raise ContractError("at least two folds")
    placed = samples.withColumn("__d", F.col(time).cast("date"))
    days = placed.groupBy(*by, F.col("__d").alias("__day")).agg(F.count(F.lit(1)).alias("__m"))
    before = F.sum("__m").over(Window.partitionBy(*by).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1))
    days = days.select(*[F.col(c).alias(f"__by_{c}") for c in by], "__day", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__m").over(Window.partitionBy(*by)).alias("__all"))
    match = F.col("__d").eqNullSafe(F.col("__day"))
    for c in by:
        match = match & (placed[c] == F.col(f"__by_{c}"))
    n = F.col("__all")
    k = F.col("__before") + F.row_number().over(Window.partitionBy(*by, "__d").orderBy(time, "sample_id")) - 1
    small, longer = F.floor(n / folds), F.pmod(n, F.lit(folds))
    block = F.when(k < longer * (small + 1), F.floor(k / (small + 1))).otherwise(longer + F.floor((k - longer * (small + 1)) / F.greatest(small, F.lit(1))))
    return placed.join(days, match).withColumn("fold", (block + 1).cast("int")).drop("__d", "__day", "__before", "__all", *[f"__by_{c}" for c in by])


def purged_kfold(samples: DataFrame, calendar: DataFrame, folds: int, embargo: int = 0, date: str = "session", by: Sequence[str] = ()) -> DataFrame:
    """Each fold validates one block; training samples whose labels overlap it are purged, and those
    observed in the ``embargo`` sessions after it are embargoed. Folds are few and explode the samples.
    ``by`` names columns each of whose values is split by itself."""
    blocks = fold_blocks(samples, folds, by=by)
    spans = blocks.groupBy(*by, F.col("fold").alias("__fold")).agg(F.min("observation_time").alias("__start"), F.max("observation_time").alias("__end"))
    days = session_index(calendar, date)
    # the sessions numbered after the last one at or before a block's end: both sides have a row for each fold or day
    ends = spans.join(days, F.col(date) <= F.col("__end").cast("date")).groupBy(*by, "__fold", "__start", "__end").agg(F.max("session_number").alias("__s"))
    numbered = blocks.withColumn("__day", F.col("observation_time").cast("date")).join(days.withColumnRenamed(date, "__day"), "__day", "left").drop("__day")
    rows = numbered.withColumn("__fold", F.explode(F.sequence(F.lit(1), F.lit(folds)))).join(F.broadcast(ends), [*by, "__fold"])  # one row for each fold
    overlap = (F.col("label_start") <= F.col("__end")) & (F.col("label_end") >= F.col("__start"))
    after = (F.col("session_number") > F.col("__s")) & (F.col("session_number") <= F.col("__s") + embargo)
    role = F.when(F.col("fold") == F.col("__fold"), "validation").when(overlap, "purged").when(F.coalesce(after, F.lit(False)), "embargoed").otherwise("train")
    return rows.select(*by, F.col("__fold").alias("fold"), "sample_id", role.alias("role"))


def walk_forward(samples: DataFrame, calendar: DataFrame, train: int, validation: int, test: int, step: int, embargo: int = 0, expanding: bool = True, date: str = "session") -> DataFrame:
    """Folds that move through the calendar; a training label has to be over and available before the
    first decision of validation, a validation label before the first of test.

    Days meet folds in the calendar, which has one row a day; samples are joined on their day alone.
    """
    if min(train, validation, test, step) < 1 or embargo < 0:
        raise ContractError("windows have at least one session")
    days = session_index(calendar, date)
    last = days.agg(F.max("session_number").alias("__last"))
    offsets = last.select(F.explode(F.expr(f"filter(transform(sequence(0, cast(greatest(__last, 1) as int)), k -> k * {step}), k -> k + {train + validation + embargo + test} <= __last)")).alias("__o"))
    bounds = offsets.select(
        (F.col("__o") / step + 1).cast("int").alias("fold"), (F.lit(1) if expanding else F.col("__o") + 1).alias("a"), (F.col("__o") + train).alias("b"), (F.col("__o") + train + validation).alias("c"),
        (F.col("__o") + train + validation + embargo).alias("d"), (F.col("__o") + train + validation + embargo + test).alias("e"),
    )
    n = F.col("session_number")
    part = F.when(n <= F.col("b"), "train").when(n <= F.col("c"), "validation").when(n <= F.col("d"), "embargoed").otherwise("test")
    parts = days.join(bounds, (n >= F.col("a")) & (n <= F.col("e"))).select(F.col(date).alias("__day"), "fold", part.alias("__part"))
    rows = samples.withColumn("__day", F.col("observation_time").cast("date")).join(parts, "__day")
    first = lambda p: F.min(F.when(F.col("__part") == p, F.col("decision_time")))
    starts = rows.where("__part in ('validation', 'test')").groupBy(F.col("fold").alias("__fold")).agg(first("validation").alias("__v"), first("test").alias("__t"))
    rows = rows.join(F.broadcast(starts), F.col("fold") == F.col("__fold"), "left")  # one row for each fold
    late = lambda limit: ~((F.col("label_end") < F.col(limit)) & (F.col("label_available") <= F.col(limit)))
    role = F.when((F.col("__part") == "train") & late("__v"), "purged").when((F.col("__part") == "validation") & late("__t"), "purged").otherwise(F.col("__part"))
    return rows.select("fold", "sample_id", role.alias("role"))


def nested(samples: DataFrame, calendar: DataFrame, outer: DataFrame, folds: int, embargo: int = 0, date: str = "session") -> DataFrame:
    """Inside every outer fold (of :func:`walk_forward`), a purged k-fold over its training samples."""
    inside = outer.where("role = 'train'").select(F.col("fold").alias("outer_fold"), F.col("sample_id").alias("__id"))
    rows = samples.join(inside, F.col("sample_id") == F.col("__id")).drop("__id")
    return purged_kfold(rows, calendar, folds, embargo, date, ["outer_fold"]).withColumnRenamed("fold", "inner_fold")


def split_minutes(rows: DataFrame, entry: str, exit_: str, train_end: int, validation_end: int, test_end: int, embargo: int) -> DataFrame:
    """``part`` of intraday labels by entry and exit: purged at a boundary, embargoed after it."""
    a, b = F.col(entry), F.col(exit_)
    part = (
        F.when(a < train_end, F.when(b <= train_end, "train").otherwise("purged_train_boundary"))
        .when(a < train_end + embargo, "embargo_after_train")
        .when(a < validation_end, F.when(b <= validation_end, "validation").otherwise("purged_validation_boundary"))
        .when(a < validation_end + embargo, "embargo_after_validation")
        .when(a < test_end, F.when(b <= test_end, "test").otherwise("purged_test_boundary"))
        .otherwise("outside")
    )
    return rows.withColumn("part", part)


def fit_scope(fitted: DataFrame, certified: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sample ids that were fitted without being certified for training, or the other way round."""
    a, b = fitted.select(*keys), certified.select(*keys)
    return a.exceptAll(b).withColumn("finding", F.lit("not_certified")).unionByName(b.exceptAll(a).withColumn("finding", F.lit("not_fitted")))


#: What may follow each state of a trial; fixed values.
TRIAL = {None: ("started",), "started": ("completed", "failed", "pruned"), "completed": ("final",), "failed": (), "pruned": (), "final": ()}


def trial_states(events: DataFrame, trial: str = "trial", order: str = "seq", state: str = "event") -> DataFrame:
    """The latest state of each trial; an event out of order is an error."""
    w = Window.partitionBy(trial).orderBy(order)
    allowed = F.create_map(*[x for k, v in TRIAL.items() for x in (F.lit(k or ""), F.array(*[F.lit(s) for s in v]).cast("array<string>"))])
    before = F.coalesce(F.lag(state).over(w), F.lit(""))
    rows = events.withColumn("__ok", F.array_contains(F.try_element_at(allowed, before), F.col(state)))
    rows = rows.where(guard(F.coalesce(F.col("__ok"), F.lit(False)), "a trial's events are out of order"))
    return rows.groupBy(trial).agg(F.max_by(state, order).alias("state"), F.count(F.lit(1)).alias("events"))


def latest(events: DataFrame, key: Sequence[str], order: Column) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(order.desc())
    return events.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


class HoldoutLedger:
    """A holdout that can be opened once. States: frozen, prepared, opened, closed.

    The ledger is a file of its own for each state, made exclusively, on a path that the driver owns.
    """

    STATES = ("frozen", "prepared", "opened", "closed")

    def __init__(self, folder: str, holdout: str):
        self.folder, self.holdout = folder, holdout
        os.makedirs(folder, exist_ok=True)

    def _path(self, state: str) -> str:
        return os.path.join(self.folder, f"{self.holdout}.{state}.json")

    @property
    def state(self) -> str | None:
        held = [s for s in self.STATES if os.path.exists(self._path(s))]
        return held[-1] if held else None

    def advance(self, state: str, **facts) -> None:
        place = self.STATES.index(state)
        if self.state != (self.STATES[place - 1] if place else None):
            raise ContractError(f"a holdout that is {self.state or 'new'} cannot become {state}")
        try:
            with open(self._path(state), "x") as f:
                json.dump(facts, f, sort_keys=True)
        except FileExistsError as e:
            raise ContractError(f"the holdout was {state} before") from e
