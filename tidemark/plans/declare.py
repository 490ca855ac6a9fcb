"""Declared pipelines: a graph of registered operators over named datasets.

A node names an operator, its inputs (datasets or other nodes) and its parameters. Compiling checks
the graph before anything runs: unknown operators, inputs and parameters, cycles, and features or
signals that descend from a label are refused. Running builds one lazy plan for each asked node.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from inspect import getsource, signature

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tidemark.errors import ContractError
from tidemark.operators.statistics import seed_of

OPERATORS: dict[str, tuple[Callable[..., DataFrame], str]] = {}

#: What a node's result is; features, signals and targets may not come from a label.
ROLES = ("data", "feature", "signal", "target", "label", "evaluation")


def operator(name: str, role: str = "data"):
    """Register a function of frames and parameters as an operator."""
    if role not in ROLES:
        raise ContractError(f"no role {role}")

    def put(function: Callable[..., DataFrame]):
        OPERATORS[name] = (function, role)
        return function

    return put


@dataclass(frozen=True)
class Node:
    name: str
    operator: str
    inputs: tuple[str, ...]
    parameters: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Pipeline:
    nodes: tuple[Node, ...]

    def compile(self, datasets: Sequence[str]) -> list[Node]:
        """Nodes in an order in which each stands after its inputs."""
        by_name = {n.name: n for n in self.nodes}
        if len(by_name) != len(self.nodes) or set(by_name) & set(datasets):
            raise ContractError("a name is used twice")
        for n in self.nodes:
            if n.operator not in OPERATORS:
                raise ContractError(f"{n.name}: no operator {n.operator}")
            takes = list(signature(OPERATORS[n.operator][0]).parameters)
            unknown = set(n.parameters) - set(takes[len(n.inputs) :])
            if unknown:
                raise ContractError(f"{n.name}: no parameter {', '.join(sorted(unknown))}")
            for i in n.inputs:
                if i not in by_name and i not in datasets:
                    raise ContractError(f"{n.name}: no input {i}")
        order: list[Node] = []
        labelled: set[str] = set()
        left = dict(by_name)
        while left:
            ready = sorted(n for n, node in left.items() if not any(i in left for i in node.inputs))
            if not ready:
                raise ContractError("the graph has a cycle")
            for name in ready:
                node = left.pop(name)
                role = OPERATORS[node.operator][1]
                tainted = role == "label" or any(i in labelled for i in node.inputs)
                if tainted and role in ("feature", "signal", "target"):
                    raise ContractError(f"{name}: a {role} descends from a label")
                if tainted:
                    labelled.add(name)
                order.append(node)
        return order

    def run(self, datasets: Mapping[str, DataFrame], *asked: str) -> dict[str, DataFrame]:
        held = dict(datasets)
        for node in self.compile(list(datasets)):
            held[node.name] = OPERATORS[node.operator][0](*[held[i] for i in node.inputs], **node.parameters)
        return {name: held[name] for name in asked or [n.name for n in self.nodes]}


def variants(node: Node, grid: Mapping[str, Sequence[object]]) -> list[Node]:
    """One node for each combination of parameter values, named by them."""
    names = sorted(grid)
    out = []
    for values in itertools.product(*[grid[n] for n in names]):
        chosen = dict(zip(names, values, strict=True))
        tag = "_".join(f"{n}{v}" for n, v in chosen.items())
        out.append(Node(f"{node.name}_{tag}", node.operator, node.inputs, {**node.parameters, **chosen}))
    return out


def descriptor(name: str) -> dict[str, object]:
    """What identifies a registered operator: name, role, parameters and a hash of its source."""
    function, role = OPERATORS[name]
    return {"name": name, "role": role, "parameters": list(signature(function).parameters), "code_hash": hashlib.sha256(getsource(function).encode()).hexdigest()}


@dataclass(frozen=True)
class Context:
    """What user code may know of its run; ``clock`` is fixed, and the seed follows from the names."""

    project: str
    run: str
    node: str
    clock: str
    parameters: Mapping[str, object] = field(default_factory=dict)
    max_rows: int = 1_000_000

    @property
    def seed(self) -> int:
        return seed_of(self.project, self.run, self.node)


def seeds(root: int, components: Sequence[str]) -> dict[str, int]:
    """A seed for each component of a run."""
    if len(set(components)) != len(components):
        raise ContractError("components differ")
    return {c: seed_of("component", root, c) for c in components}


def run_partitioned(rows: DataFrame, key: str, entry: Callable, schema: str, context: Context, states: DataFrame | None = None) -> DataFrame:
    """User code over each partition of ``rows`` by ``key`` with the state it left there before.

    ``entry(context, frame, state)`` takes a pandas frame and a text (None at first) and returns rows of
    ``schema`` and the next state. The result has the key, the rows' columns, and one row for each
    partition with ``state`` alone (see :func:`states_of`); ``states`` is (key, state) of the run before.
    More rows of a partition than the context allows are an error.
    """
    kind = rows.schema[key].dataType.simpleString()
    names = [f.name for f in StructType.fromDDL(schema).fields]
    before = states if states is not None else rows.sparkSession.createDataFrame([], f"`{key}` {kind}, state string")

    def run(group: tuple, frame: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if len(frame) > context.max_rows:
            raise ContractError(f"partition {group[0]} has {len(frame)} rows")
        state = held["state"].iloc[0] if len(held) else None
        if len(frame):
            out, state = entry(context, frame, state)
        else:
            out = pd.DataFrame(columns=names)
        out = out[names].assign(**{key: group[0], "state": None})
        return pd.concat([out, pd.DataFrame([{key: group[0], "state": state}])], ignore_index=True)[[key, *names, "state"]]

    return rows.groupBy(key).cogroup(before.groupBy(key)).applyInPandas(run, f"`{key}` {kind}, {schema}, state string")


def states_of(result: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows and the (key, state) table of a written result of :func:`run_partitioned`."""
    return result.where("state is null").drop("state"), result.where("state is not null").select(key, "state")


#: When orders may execute, how capacity bounds them, and the strongest claim that each allows; fixed values.
TIMING = {"next_open": 3, "next_bar_open": 3, "same_close": 1}
CAPACITY = {"participation": 3, "historical_volume": 2, "unlimited": 1}
CLAIMS = {1: "exploratory", 2: "indicative", 3: "executable"}


@dataclass(frozen=True)
class Semantics:
    """How a simulation executes. What it may claim is bounded by its weakest part."""

    timing: str
    capacity: str

    def __post_init__(self) -> None:
        if self.timing not in TIMING or self.capacity not in CAPACITY:
            raise ContractError("a simulation names a known timing and capacity")

    @property
    def ceiling(self) -> str:
        return CLAIMS[min(TIMING[self.timing], CAPACITY[self.capacity])]

    def require(self, claim: str) -> None:
        rank = {name: level for level, name in CLAIMS.items()}
        if rank.get(claim, 9) > rank[self.ceiling]:
            raise ContractError(f"a simulation with {self.timing} and {self.capacity} claims {self.ceiling} at most")
