"""Every registered query and its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as doubles, as the DuckDB texts give them."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    text = {n: F.col(f"`{n}`").cast("string") for n, t in kinds.items() if t == "date"}
    number = {n: F.col(f"`{n}`").cast("double") for n, t in kinds.items() if t.startswith("decimal")}
    return df.withColumns(text | number) if text or number else df


def query(name: str, sql: str | None = None, dates: tuple[str, ...] = (), decimals: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the DuckDB text of the same rows where there is one.

    ``dates`` and ``decimals`` name the columns of the text that are to be given as text and doubles.
    """
    if sql is not None and (dates or decimals):
        casts = [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in dates] + [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in decimals]
        sql = f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql}) AS rows_of_query"

    def put(function: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = lambda spark, sf_dir: plain(function(spark, sf_dir))
        if sql is not None:
            _ORACLE[name] = sql
        return function

    return put


def _load() -> None:
    from tidemark.plans import catalog  # noqa: F401  registers on import


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
