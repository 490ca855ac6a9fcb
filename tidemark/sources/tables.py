"""Scans: tables of a folder, month-partitioned bars, and JSON arrays as rows. Only Spark opens paths."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from tidemark.errors import ContractError
from tidemark.schema import describe


def scan(spark: SparkSession, sf_dir: str, name: str, schema: StructType | None = None) -> DataFrame:
    """One table of a folder; with a schema, no file has to be opened to plan."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def require_wall_clock(df: DataFrame, column: str) -> DataFrame:
    """The event time of minute data is a timestamp without zone."""
    if not isinstance(df.schema[column].dataType, TimestampNTZType):
        raise ContractError(f"{column} is {df.schema[column].dataType.simpleString()}, not timestamp_ntz")
    return df


def scan_months(spark: SparkSession, path: str, start: datetime, end: datetime, as_of: datetime, columns: Sequence[str], time: str = "dt") -> DataFrame:
    """Bars with start <= time < end, up to and at as_of, of a ``year=/month=`` layout.

    The months are a predicate on the partition columns, so files outside are never listed or read.
    """
    last = min(end, as_of)
    df = spark.read.option("recursiveFileLookup", "false").parquet(path)
    month = F.col("year").cast("int") * 12 + F.col("month").cast("int")
    lit = lambda t: F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")
    inside = (F.col(time) >= lit(start)) & (F.col(time) < lit(end)) & (F.col(time) <= lit(as_of))
    wanted = list(dict.fromkeys([*columns, time]))
    months = month.between(start.year * 12 + start.month, last.year * 12 + last.month)
    return require_wall_clock(df.where(months).where(inside).select(*wanted), time)


def json_array_rows(df: DataFrame, keys: Sequence[str], column: str, value: str, kinds: Sequence[str] | None = None, dates: Sequence[str] = ()) -> DataFrame:
    """One row for each element of a JSON array of strings, and kind if kinds are named.

    No kinds at all (an empty list) is an empty result; text that is no array has no rows. ``dates``
    are cast, null where they are no date.
    """
    rows = df.select(*keys, *[F.col(d).try_cast("date").alias(d) for d in dates], F.explode(F.from_json(F.col(column), "array<string>")).alias(value))
    if kinds is None:
        return rows
    return rows.withColumn("kind", F.explode(F.array(*[F.lit(k) for k in kinds]).cast("array<string>")))


def discover(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> DataFrame:
    """Physical columns of tables: (table_name, position, column_name, data_type)."""
    rows = [(n, k, c, t) for n in names for k, (c, t, _) in enumerate(describe(scan(spark, sf_dir, n)))]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")


def view_shape(spark: SparkSession, sql: str) -> str:
    """The shape of a view's text, from its parsed plan: projection, union_all, join or parquet; others are an error."""
    names, todo = [], [spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)]
    while todo:
        node = todo.pop()
        names.append(node.nodeName())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    text = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString().lower()
    if "Distinct" in names or "Aggregate" in names or ("Union" in names and "Join" in names):
        raise ContractError("a view is a projection, a UNION ALL, a join or a Parquet scan")
    if "Union" in names:
        return "union_all"
    if "Join" in names:
        return "join"
    return "parquet" if "read_parquet" in text or "[parquet," in text else "projection"
