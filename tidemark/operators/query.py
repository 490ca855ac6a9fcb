"""Bounded requests: typed projection, filters, order and limits as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce
from operator import and_
from typing import Any
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.schema import Dataset, typed


@dataclass(frozen=True)
class Filter:
    """One predicate. ``range`` is closed at both ends; ``in`` holds distinct values."""

    column: str
    operator: str
    values: tuple[Any, ...] = ()

    #: Operators and how many values they take (None: one or more).
    ARITY = {"eq": 1, "ne": 1, "lt": 1, "le": 1, "gt": 1, "ge": 1, "in": None, "range": 2, "is_null": 0, "is_valid": 0}

    def __post_init__(self) -> None:
        if self.operator not in self.ARITY:
            raise ContractError(f"no filter operator {self.operator}")
        arity = self.ARITY[self.operator]
        if (arity is None and not self.values) or (arity is not None and len(self.values) != arity):
            raise ContractError(f"{self.operator} on {self.column} takes {'some' if arity is None else arity} values, not {len(self.values)}")
        if any(v is None for v in self.values):
            raise ContractError("null is asked for by is_null")
        if self.operator == "range" and self.values[0] > self.values[1]:
            raise ContractError(f"the range on {self.column} is empty")

    def predicate(self) -> Column:
        c = F.col(self.column)
        match self.operator:
            case "eq":
                return c == F.lit(self.values[0])
            case "ne":
                return c != F.lit(self.values[0])
            case "lt":
                return c < F.lit(self.values[0])
            case "le":
                return c <= F.lit(self.values[0])
            case "gt":
                return c > F.lit(self.values[0])
            case "ge":
                return c >= F.lit(self.values[0])
            case "in":
                return c.isin(*sorted(set(self.values)))
            case "range":
                return c.between(F.lit(self.values[0]), F.lit(self.values[1]))
            case "is_null":
                return c.isNull()
        return c.isNotNull()


def where(df: DataFrame, filters: Sequence[Filter]) -> DataFrame:
    """All filters together; every one reaches the scan if its column does."""
    return df.where(reduce(and_, [f.predicate() for f in filters])) if filters else df


def date_range(column: str, start: date, end: date) -> Column:
    """Closed range of dates. On a timestamp the end is that day's midnight, so later rows of the day are out."""
    return F.col(column).between(F.lit(start), F.lit(end))


def instant_range(column: str, start: datetime, end: datetime, as_of: datetime) -> Column:
    """start <= column < end and column <= as_of, wall-clock times without zone."""
    c = F.col(column)
    lit = lambda v: F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")
    return (c >= lit(start)) & (c < lit(end)) & (c <= lit(as_of))


def wall_clock(text: str, zone: str) -> datetime:
    """An ISO instant with offset as local wall-clock time of a zone."""
    at = datetime.fromisoformat(text)
    if at.tzinfo is None:
        raise ContractError(f"{text} has no offset")
    return at.astimezone(ZoneInfo(zone)).replace(tzinfo=None)


def cutoff(as_of: date | datetime) -> datetime:
    """A date as the exclusive midnight after it; an instant as it is."""
    if isinstance(as_of, datetime):
        return as_of
    return datetime.combine(as_of + timedelta(days=1), datetime.min.time())


def stable_sort(df: DataFrame, key: Sequence[str], order: Sequence[tuple[str, str]]) -> DataFrame:
    """Sort with nulls last. The order has to begin with the whole key, ascending."""
    if [c for c, _ in order[: len(key)]] != list(key) or any(way != "asc" for _, way in order[: len(key)]):
        raise ContractError(f"an order has to begin with {', '.join(key)} ascending")
    return df.orderBy(*[F.col(c).asc_nulls_last() if way == "asc" else F.col(c).desc_nulls_last() for c, way in order])


def universe_filter(df: DataFrame, column: str, universe: DataFrame | Sequence[str]) -> DataFrame:
    """Rows of an instrument universe: literals for a short list, a semi join for a table."""
    if isinstance(universe, DataFrame):
        members = universe.select(F.col(universe.columns[0]).alias("__member"))
        return df.join(members, df[column] == members["__member"], "left_semi")
    return df.where(F.col(column).isin(*sorted(set(universe))))


def within_rows(df: DataFrame, most: int) -> DataFrame:
    """Rows of a result that may have at most ``most``; more raise an error, they are not cut off.

    One row over the bound is enough to know, so the guard counts a limited prefix.
    """
    guard = df.limit(most + 1).agg(F.count(F.lit(1)).alias("__rows"))
    guard = guard.where(F.when(F.col("__rows") <= most, F.lit(True)).otherwise(F.raise_error(F.lit(f"more than {most} rows")).cast("boolean")))
    return df.crossJoin(F.broadcast(guard)).drop("__rows")  # one row


def scope_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and the largest written size of each column, in bytes."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), *[F.max(F.octet_length(F.col(c).cast("string"))).alias(f"{c}_bytes") for c in columns])


@dataclass(frozen=True)
class Request:
    """A bounded request of one dataset."""

    dataset: Dataset
    columns: tuple[str, ...]
    filters: tuple[Filter, ...] = ()
    start: date | datetime | None = None
    end: date | datetime | None = None
    as_of: datetime | None = None
    universe: tuple[str, ...] | None = None
    instrument: str | None = None
    order: tuple[tuple[str, str], ...] = ()
    limit: int | None = None
    max_rows: int | None = None
    extra: dict = field(default_factory=dict, compare=False)

    def plan(self, source: DataFrame) -> DataFrame:
        """Projection, then time, universe and filters, order and limit."""
        d = self.dataset
        df = typed(source, d, self.columns)
        if self.start is not None and self.end is not None and d.event_time:
            if d.field(d.event_time).logical == "date":
                df = df.where(date_range(d.event_time, self.start, self.end))
            else:
                df = df.where(instant_range(d.event_time, self.start, self.end, self.as_of or self.end))
        if self.universe is not None:
            if self.instrument is None:
                raise ContractError(f"{d.name} has no instrument to choose by")
            df = universe_filter(df, self.instrument, self.universe)
        df = where(df, self.filters)
        if self.order:
            df = stable_sort(df, d.key, self.order)
        if self.limit is not None:
            return df.limit(self.limit)
        return within_rows(df, self.max_rows) if self.max_rows is not None else df
