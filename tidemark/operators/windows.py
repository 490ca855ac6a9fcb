"""Ordered transforms per entity and transforms across a date's entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.functions.scalars import ratio


def lag(df: DataFrame, entity: Sequence[str], order: Sequence[str], column: str, periods: int, name: str) -> DataFrame:
    """The value ``periods`` >= 1 rows earlier; the first rows have null."""
    if periods < 1:
        raise ContractError("lag looks back at least one row")
    return df.withColumn(name, F.lag(column, periods).over(Window.partitionBy(*entity).orderBy(*order)))


ROLLING = {"mean": F.avg, "sum": F.sum, "std": F.stddev_samp, "min": F.min, "max": F.max}


def rolling(df: DataFrame, entity: Sequence[str], order: Sequence[str], column: str, window: int, how: str, name: str, min_periods: int | None = None) -> DataFrame:
    """An aggregate of the last ``window`` rows; null until ``min_periods`` values. ``std`` is the sample's."""
    if how not in ROLLING or window < 1:
        raise ContractError(f"no rolling {how} over {window} rows")
    w = Window.partitionBy(*entity).orderBy(*order).rowsBetween(1 - window, 0)
    return df.withColumn(name, F.when(F.count(column).over(w) >= (window if min_periods is None else min_periods), ROLLING[how](column).over(w)))


def cross_section(df: DataFrame, date: Sequence[str], column: str, method: str, name: str, code: str | None = None, limits: tuple[float, float] = (0.05, 0.95)) -> DataFrame:
    """``rank`` (share of values not greater, averaged over ties), ``zscore`` (sample), ``demean`` or
    ``winsorize`` (at interpolated quantiles) of a column within each date."""
    w, x = Window.partitionBy(*date), F.col(column)
    n = F.count(column).over(w)
    if method == "rank":
        first = F.rank().over(w.orderBy(x.asc_nulls_last()))
        ties = F.count(column).over(Window.partitionBy(*date, column))
        return df.withColumn(name, F.when(x.isNotNull(), (first + (ties - 1) / 2) / n))
    if method == "zscore":
        return df.withColumn(name, F.try_divide(x - F.avg(x).over(w), F.stddev_samp(x).over(w)))
    if method == "demean":
        return df.withColumn(name, x - F.avg(x).over(w))
    if method == "winsorize":
        low, high = (F.percentile(x, F.lit(q)).over(w) for q in limits)
        return df.withColumn(name, F.when(x.isNotNull(), F.greatest(F.least(x, high), low)))
    raise ContractError(f"no cross-section method {method}")


def calendar_align(df: DataFrame, calendar: DataFrame, entity: Sequence[str], date: str, column: str, method: str) -> DataFrame:
    """The column on every calendar date of every entity: on the date (``exact``) or the last known (``backward``)."""
    if method not in ("exact", "backward"):
        raise ContractError("alignment is exact or backward")
    days = calendar.select(F.col(calendar.columns[0]).alias(date)).distinct()
    spans = df.groupBy(*entity).agg(F.min(date).alias("__first"))
    grid = spans.join(days, days[date] >= spans["__first"] if method == "backward" else F.lit(True)).select(*entity, date, F.lit(True).alias("__asked"))
    both = grid.join(df.select(*entity, date, column), [*entity, date], "full_outer" if method == "backward" else "left")
    if method == "exact":
        return both.drop("__asked")
    w = Window.partitionBy(*entity).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(column, F.last(column, ignorenulls=True).over(w)).where("__asked").drop("__asked")


def forward_label(df: DataFrame, entity: Sequence[str], order: Sequence[str], price: str, horizon: int, available: str, name: str = "label") -> DataFrame:
    """price ``horizon`` rows ahead over the price now, less one; visible when the exit row is."""
    if horizon < 1:
        raise ContractError("a label looks ahead at least one row")
    w = Window.partitionBy(*entity).orderBy(*order)
    return df.withColumn(name, ratio(F.lead(price, horizon).over(w), F.col(price)) - 1).withColumn(f"{name}_available", F.lead(available, horizon).over(w))


def session_index(calendar: DataFrame, date: str) -> DataFrame:
    """The calendar with the number of each session. A calendar has one row a day, so one ordered pass is small."""
    return calendar.select(date).distinct().withColumn("session_number", F.row_number().over(Window.orderBy(date)))


def event_window(events: DataFrame, prices: DataFrame, calendar: DataFrame, entity: str, anchor: str, date: str, before: int, after: int) -> DataFrame:
    """Prices of an event's entity from ``before`` sessions ahead of its anchor to ``after`` behind it."""
    numbers = session_index(calendar, date)
    at = events.join(numbers.select(F.col(date).alias(anchor), F.col("session_number").alias("__anchor")), anchor)
    offsets = at.withColumn("relative_session", F.explode(F.sequence(F.lit(-before), F.lit(after)))).withColumn("session_number", F.col("__anchor") + F.col("relative_session"))
    days = offsets.join(numbers, "session_number").drop("__anchor", "session_number")
    return days.join(prices, [entity, date])


def gap_islands(df: DataFrame, entity: Sequence[str], time: str, step_seconds: int) -> DataFrame:
    """``island``: number of the run of rows that follow each other by exactly the step."""
    w = Window.partitionBy(*entity).orderBy(time)
    broken = F.when(F.timestamp_diff("MICROSECOND", F.lag(time).over(w), F.col(time)) == step_seconds * 1_000_000, 0).otherwise(1)
    return df.withColumn("__gap", broken).withColumn("island", F.sum("__gap").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__gap")


def drawdown(df: DataFrame, entity: Sequence[str], order: Sequence[str], equity: str, floor: float | None = None) -> DataFrame:
    """equity over its running peak, less one; with ``floor`` the peak starts there."""
    peak = F.max(equity).over(Window.partitionBy(*entity).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    peak = peak if floor is None else F.greatest(peak, F.lit(floor))
    return df.withColumn("drawdown", F.try_divide(F.col(equity), peak) - 1)


def running_sum(df: DataFrame, entity: Sequence[str], order: Sequence[str], column: str, name: str) -> DataFrame:
    w = Window.partitionBy(*entity).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(column).over(w))
