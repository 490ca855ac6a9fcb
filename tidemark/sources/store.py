"""Snapshots and results: Parquet with a manifest that says what was written.

A manifest is a one-row JSON dataset beside the data, written after it, so a folder without one was
never finished. Paths are opened by Spark alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators.quality import content_fingerprint


def write_snapshot(df: DataFrame, path: str, event_time: str | None = None) -> dict:
    """Write a frame as zstd Parquet, by event month if it has an event time, then its manifest."""
    out = df
    by: list[str] = []
    if event_time is not None:
        out = out.withColumn("year", F.year(event_time)).withColumn("month", F.month(event_time))
        by = ["year", "month"]
    writer = out.repartition(*by) if by else out
    writer.write.option("compression", "zstd").partitionBy(*by).parquet(f"{path}/data")
    facts = fingerprint(df.sparkSession, path, df.columns) | {"schema": json.loads(df.schema.json())}
    df.sparkSession.createDataFrame([(json.dumps(facts, sort_keys=True),)], "manifest string").coalesce(1).write.text(f"{path}/manifest")
    return facts


def fingerprint(spark: SparkSession, path: str, columns: Sequence[str]) -> dict:
    return content_fingerprint(spark.read.parquet(f"{path}/data").select(*columns)).first().asDict()


def manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/manifest").first()[0])


def verify_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot's rows, if its content still is what the manifest says; else an error."""
    facts = manifest(spark, path)
    columns = [f["name"] for f in facts["schema"]["fields"]]
    now = fingerprint(spark, path, columns)
    if any(now[k] != facts[k] for k in now):
        raise ContractError(f"the snapshot in {path} is not what was written")
    return spark.read.parquet(f"{path}/data").select(*columns)


def publish_result(tables: Mapping[str, DataFrame], path: str) -> dict:
    """Write a result's tables under one folder; the manifest of each closes it."""
    return {name: write_snapshot(df, f"{path}/{name}") for name, df in tables.items()}


def read_result(spark: SparkSession, path: str, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = verify_snapshot(spark, f"{path}/{table}")
    return df.select(*columns) if columns else df


def publication_summary(factors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a factor table publishes: count and dates for each factor, and rows for each reason."""
    by_factor = factors.groupBy("factor_id").agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count_distinct("code").alias("codes"))
    by_reason = factors.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    return by_factor, by_reason


def kept(df: DataFrame, by: str) -> DataFrame:
    """``df`` written once, bucketed by a column, and read back: what reads it often computes it once,
    and windows and groups within ``by`` need no exchange.

    The files lie under ``spark.checkpoint.dir`` (without one, in the warehouse) until the driver ends.
    """
    spark = df.sparkSession
    name = f"kept_{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), by)
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        writer = writer.option("path", f"{folder.rstrip('/')}/tidemark/{name}")
    writer.saveAsTable(name)
    return spark.table(name)


class Bundle:
    """Materialized frames by request id: merged from parts, selected by request."""

    def __init__(self, frames: Mapping[str, DataFrame] | None = None):
        self.frames = dict(frames or {})

    def merge(self, *others: Bundle) -> Bundle:
        """All requests; one that two bundles answer with different plans is an error."""
        out = dict(self.frames)
        for other in others:
            for request, df in other.frames.items():
                if request in out and not out[request].sameSemantics(df):
                    raise ContractError(f"request {request} has two answers")
                out[request] = df
        return Bundle(out)

    def select(self, *requests: str) -> Bundle:
        if lost := sorted(set(requests) - set(self.frames)):
            raise ContractError(f"no data for {', '.join(lost)}")
        return Bundle({r: self.frames[r] for r in requests})


def verified_months(spark: SparkSession, path: str, facts: Mapping[tuple[int, int], dict], key: Sequence[str]) -> DataFrame:
    """Rows of a ``year=/month=`` layout, each month checked against its receipt (row_count, content_sum, content_xor).

    A month that is not the one its receipt describes, without a receipt or missing, and a repeated
    key within one, is an error; months are read once for the check and stream afterwards.
    """
    df = spark.read.parquet(path)
    columns = [c for c in df.columns if c not in ("year", "month")]
    h = F.xxhash64(*[F.col(c) for c in columns])
    seen = df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("content_sum"), F.bit_xor(h).alias("content_xor"))
    found = {(int(r.year), int(r.month)): {"row_count": r.row_count, "content_sum": r.content_sum, "content_xor": r.content_xor} for r in seen.collect()}  # one row a month
    if wrong := sorted(m for m in {*found, *facts} if found.get(m) != facts.get(m)):
        raise ContractError(f"months {wrong} are not what their receipts say")
    if not df.groupBy("year", "month", *key).count().where("count > 1").isEmpty():
        raise ContractError("a key occurs twice within a month")
    return df
