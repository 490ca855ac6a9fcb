"""Gates that a dataset has to pass, as rows of findings or as guards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators.pit import guard
from tidemark.schema import require_columns


def key_findings(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that are null or occur twice: the key, its rows and the finding."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
    empty = counted.select(*key, "rows", F.when(F.greatest(*[F.col(k).isNull().cast("int") for k in key], F.lit(0)) == 1, F.lit("null_key")).when(F.col("rows") > 1, F.lit("duplicate_key")).alias("finding"))
    return empty.where("finding is not null")


def quality_gate(df: DataFrame, types: Mapping[str, str], key: Sequence[str], required: Sequence[str] = (), inside: Column | None = None) -> DataFrame:
    """The rows as they are; a missing column, another type, a null, a row outside or a repeated key is an error."""
    require_columns(df, types)
    rows = df
    for c in (*key, *required):
        rows = rows.where(guard(F.col(c).isNotNull(), f"{c} is null"))
    if inside is not None:
        rows = rows.where(guard(F.coalesce(inside, F.lit(False)), "a row lies outside the request"))
    twice = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").agg(F.count(F.lit(1)).alias("__twice"))
    sound = twice.where(guard(F.col("__twice") == 0, "a key occurs twice"))
    return rows.crossJoin(F.broadcast(sound)).drop("__twice")  # one row


def preflight(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> dict[str, int]:
    """The optimizer's estimate of a frame's size, without running it; one beyond the budget is an error.

    Spark knows rows only of tables with statistics; without, rows are bytes over the schema's default row size.
    """
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    size = int(str(stats.sizeInBytes()))
    rows = int(str(stats.rowCount().get())) if stats.rowCount().isDefined() else size // max(1, df._jdf.schema().defaultSize())
    if (max_bytes is not None and size > max_bytes) or (max_rows is not None and rows > max_rows):
        raise ContractError(f"an estimate of {rows} rows and {size} bytes passes the budget")
    return {"rows": rows, "bytes": size}


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: text and binaries as they are, other values by their type's width, nested ones as JSON."""
    parts = [F.lit(0).cast("bigint")]
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)))
        elif kind.startswith(("array", "map", "struct")):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0)))
        else:
            parts.append(F.lit({"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}.get(kind, 16 if kind.startswith("decimal") else 8)))
    return sum(parts[1:], parts[0])


def within_budget(df: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    """The rows as they are; more rows or bytes than the budget are an error when they are read."""
    total = df.agg(F.count(F.lit(1)).alias("__rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("__bytes"))
    total = total.where(guard((F.col("__rows") <= max_rows) & (F.col("__bytes") <= max_bytes), "the rows pass the budget"))
    return df.crossJoin(F.broadcast(total)).drop("__rows", "__bytes")  # one row


def concatenate(frames: Sequence[DataFrame], max_bytes: int) -> DataFrame:
    """Frames with the same columns, one after another, within a budget of bytes."""
    if not frames or any(set(f.columns) != set(frames[0].columns) for f in frames):
        raise ContractError("frames to concatenate have the same columns")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return within_budget(out, (1 << 62), max_bytes)


def content_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-insensitive hash of a table's content."""
    h = F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("content_sum"), F.coalesce(F.bit_xor(F.xxhash64(*[F.col(c) for c in df.columns])), F.lit(0)).alias("content_xor"))


def observation_facts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts by dataset."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("dataset"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
