"""Universe algebra: instruments with a decision and its reason, never a bare list.

A universe has the columns instrument, included, reason and attributes. ``attributes`` is a map of
strings; where both sides of a combination carry an attribute it has to be the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators.pit import effective, guard

#: Reasons, fixed values.
INCLUDED, NO_ROW, NOT_VISIBLE, NOT_EFFECTIVE, FILTERED, EXCLUDED = "included", "no_row", "not_visible", "not_effective", "filtered", "excluded"


def base(members: DataFrame, facts: DataFrame, instrument: str, available: str, start: str, end: str, as_of: Column, attributes: tuple[str, ...] = ()) -> DataFrame:
    """Every member, included if exactly one of its facts is visible and in force; several are an error."""
    seen = F.col(available) <= as_of
    live = seen & effective(start, end, as_of)
    named = F.map_from_arrays(F.array(*[F.lit(a) for a in attributes]), F.array(*[F.col(a).cast("string") for a in attributes])) if attributes else F.create_map().cast("map<string,string>")
    counted = facts.groupBy(F.col(instrument).alias("__i")).agg(F.count_if(seen).alias("__seen"), F.count_if(live).alias("__live"), F.max_by(F.when(live, named), live.cast("int")).alias("attributes"))
    both = members.select(F.col(members.columns[0]).alias("instrument")).distinct().join(counted, F.col("instrument") == F.col("__i"), "left")
    reason = F.when(F.col("__live") == 1, INCLUDED).when(F.col("__i").isNull(), NO_ROW).when(F.col("__seen") == 0, NOT_VISIBLE).otherwise(NOT_EFFECTIVE)
    rows = both.where(guard(F.coalesce("__live", F.lit(0)) <= 1, "two facts of an instrument are in force"))
    return rows.select("instrument", (reason == INCLUDED).alias("included"), reason.alias("reason"), F.when(reason == INCLUDED, F.col("attributes")).alias("attributes"))


def filtered(universe: DataFrame, attribute: str, operator: str, *values: str) -> DataFrame:
    """Keep included members whose attribute passes; an included member without it is an error."""
    value = F.element_at("attributes", F.lit(attribute))
    tests = {"eq": lambda: value == F.lit(values[0]), "in": lambda: value.isin(*values), "is_true": lambda: F.lower(value) == "true", "is_false": lambda: F.lower(value) == "false"}
    if operator not in tests or (operator == "eq" and len(values) != 1) or (operator == "in" and not values):
        raise ContractError(f"no universe filter {operator} with {len(values)} values")
    rows = universe.where(guard(~F.col("included") | value.isNotNull(), f"an included member has no attribute {attribute}"))
    keep = F.col("included") & tests[operator]()
    return rows.select("instrument", keep.alias("included"), F.when(keep, F.col("reason")).when(F.col("included"), F.lit(FILTERED)).otherwise(F.col("reason")).alias("reason"), "attributes")


def _both(left: DataFrame, right: DataFrame) -> DataFrame:
    a = left.select("instrument", F.col("included").alias("a"), F.col("reason").alias("ra"), F.col("attributes").alias("ma"))
    b = right.select("instrument", F.col("included").alias("b"), F.col("reason").alias("rb"), F.col("attributes").alias("mb"))
    both = a.join(b, "instrument", "full_outer").withColumns({"a": F.coalesce("a", F.lit(False)), "b": F.coalesce("b", F.lit(False))})
    shared = F.filter(F.map_keys("ma"), lambda k: F.map_contains_key("mb", k) & ~F.element_at("ma", k).eqNullSafe(F.element_at("mb", k)))
    return both.where(guard(~(F.col("a") & F.col("b")) | (F.coalesce(F.size(shared), F.lit(0)) <= 0), "an attribute differs between the sides"))


def _merged() -> Column:
    empty = F.create_map().cast("map<string,string>")
    own, other = F.coalesce("ma", empty), F.coalesce("mb", empty)
    return F.map_concat(own, F.map_filter(other, lambda k, _: ~F.map_contains_key(own, k)))


def _decided(both: DataFrame, keep: Column) -> DataFrame:
    reason = F.when(keep, F.lit(INCLUDED)).when(F.col("a") & F.col("b"), F.lit(EXCLUDED)).when(F.col("a"), F.coalesce("rb", F.lit(EXCLUDED))).otherwise(F.coalesce("ra", "rb"))
    merged = F.when(F.col("a") & F.col("b"), _merged()).when(F.col("a"), F.col("ma")).otherwise(F.col("mb"))
    return both.select("instrument", keep.alias("included"), reason.alias("reason"), F.when(keep, merged).alias("attributes"))


def union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Included on either side."""
    return _decided(_both(left, right), F.col("a") | F.col("b"))


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Included on both sides."""
    return _decided(_both(left, right), F.col("a") & F.col("b"))


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Included on the left and not on the right."""
    return _decided(_both(left, right), F.col("a") & ~F.col("b"))


def require_members(universe: DataFrame) -> DataFrame:
    """The universe as it is; one without included members is an error."""
    some = universe.agg(F.max(F.col("included").cast("int")).alias("__some")).where(guard(F.coalesce("__some", F.lit(0)) == 1, "the universe is empty"))
    return universe.crossJoin(F.broadcast(some)).drop("__some")  # one row


@dataclass(frozen=True)
class Step:
    """A step of a declared universe: ``kind`` base (of a dataset), filter, union, intersection, difference or as_of."""

    name: str
    kind: str
    inputs: tuple[str, ...]
    parameters: tuple = ()


#: Inputs of each kind of step.
INPUTS = {"base": 1, "filter": 1, "as_of": 1, "union": 2, "intersection": 2, "difference": 2}


def compile_steps(steps: tuple[Step, ...], datasets: tuple[str, ...], clock: str) -> list[Step]:
    """Steps in an order in which each stands after its inputs; the last of them is the one that no other reads.

    Unknown kinds and inputs, repeated names, cycles, several results and an ``as_of`` that is not the
    plan's clock are errors.
    """
    left = {s.name: s for s in steps}
    if len(left) != len(steps) or set(left) & set(datasets):
        raise ContractError("a name is used twice")
    for s in steps:
        if len(s.inputs) != INPUTS.get(s.kind, -1):
            raise ContractError(f"{s.name}: no step {s.kind} of {len(s.inputs)} inputs")
        if any(i not in (datasets if s.kind == "base" else left) for i in s.inputs):
            raise ContractError(f"{s.name}: an input is unknown")
        if s.kind == "as_of" and s.parameters != (clock,):
            raise ContractError(f"{s.name}: its clock is not the plan's, {clock}")
    ends = set(left) - {i for s in steps for i in s.inputs}
    order: list[Step] = []
    while left:
        ready = sorted(n for n, s in left.items() if not any(i in left for i in s.inputs))
        if not ready:
            raise ContractError("the universe has a cycle")
        order += [left.pop(n) for n in ready]
    if len(ends) != 1:
        raise ContractError("a universe has one result")
    return sorted(order, key=lambda s: s.name in ends)


def evaluate(steps: tuple[Step, ...], datasets: dict[str, DataFrame], clock: str) -> DataFrame:
    """The result of a declared universe, one lazy plan; one without included members is an error."""
    held = dict(datasets)
    combine = {"union": union, "intersection": intersection, "difference": difference, "base": lambda x: x, "as_of": lambda x: x}
    for s in compile_steps(steps, tuple(datasets), clock):
        inputs = [held[i] for i in s.inputs]
        held[s.name] = filtered(inputs[0], *s.parameters) if s.kind == "filter" else combine[s.kind](*inputs)
    return require_members(held[s.name])
