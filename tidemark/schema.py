"""Logical types and schema contracts of datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.errors import ContractError

#: Logical type names and the Spark types they are stored as.
LOGICAL = {
    "string": "string",
    "varchar": "string",
    "boolean": "boolean",
    "bool": "boolean",
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "float32": "float",
    "float64": "double",
    "decimal128": "decimal(38,18)",
    "date32": "date",
    "timestamp": "timestamp_ntz",
    "integer": "bigint",
    "number": "double",
    "decimal": "decimal(38,9)",
    "units": "bigint",
    "date": "date",
    "instant": "timestamp_ntz",
    "string_list": "array<string>",
}


@dataclass(frozen=True)
class Field:
    """A public field: its name, logical type and the physical column it is read from."""

    name: str
    logical: str
    physical: str | None = None
    nullable: bool = True

    @property
    def source(self) -> str:
        return self.physical or self.name

    @property
    def spark_type(self) -> str:
        if self.logical not in LOGICAL:
            raise ContractError(f"{self.name}: no logical type {self.logical}")
        return LOGICAL[self.logical]


@dataclass(frozen=True)
class Dataset:
    """A dataset's contract: fields in public order, key, event time and version columns."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    event_time: str | None = None
    available: tuple[str, ...] = ()
    revision: tuple[str, ...] = ()
    entity: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ContractError(f"{self.name}: a field is declared twice")
        for name in (*self.key, *self.available, *self.revision, *self.entity, *((self.event_time,) if self.event_time else ())):
            if name not in names:
                raise ContractError(f"{self.name}: {name} is not a field")

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise ContractError(f"{self.name} has no field {name}")


def describe(df: DataFrame) -> list[tuple[str, str, bool]]:
    """Physical column inventory: (name, type, nullable)."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]


def require_columns(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Raise unless the columns are there (and of the types named, if a mapping is given)."""
    have = dict(df.dtypes)
    wanted = columns if isinstance(columns, Mapping) else dict.fromkeys(columns)
    for name, kind in wanted.items():
        if name not in have:
            raise ContractError(f"column {name} is missing")
        if kind is not None and have[name] != kind:
            raise ContractError(f"column {name} is {have[name]}, not {kind}")
    return df


def typed(df: DataFrame, dataset: Dataset, names: Sequence[str] | None = None) -> DataFrame:
    """Cast physical columns to logical types under their public names.

    Key and event time have to be among the names; the order is the dataset's.
    """
    wanted = set(names) if names is not None else {f.name for f in dataset.fields}
    for name in (*dataset.key, *((dataset.event_time,) if dataset.event_time else ())):
        if name not in wanted:
            raise ContractError(f"{dataset.name}: {name} has to be projected")
    for name in wanted:
        dataset.field(name)
    return df.select(*[F.col(f.source).cast(f.spark_type).alias(f.name) for f in dataset.fields if f.name in wanted])
