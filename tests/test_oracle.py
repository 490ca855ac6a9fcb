"""Every registered query against its DuckDB text on the small tables."""

import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return c


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    out = []
    for r in values:
        cells = []
        for k in order:
            v = r[k]
            cells.append("null" if v is None or (isinstance(v, float) and math.isnan(v)) else f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v))
        out.append(tuple(cells))
    return sorted(out)


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_are_those_of_the_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = df.collect()
    cursor = duck.cursor()
    found = cursor.execute(SQL[name])
    columns = [c[0] for c in found.description]
    want = found.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, got) == rows(columns, want)


def check_reality(df, spark, scale):
    from tidemark.operators import statistics
    from tidemark.plans.inference import _clean

    x, _ = statistics.matrix_of(_clean(spark, SF).withColumn("nation", F.col("nation").cast("string")), "day", "nation", "r")
    want = max(0.0, float((np.sqrt(len(x)) * x.mean(axis=0) / (x.std(axis=0, ddof=1) if scale else 1)).max()))
    (row,) = df.collect()
    assert row.statistic == pytest.approx(want) and 1 / 301 <= row.p_value <= 1 and row.replications == 300


def check_cash(df, spark):
    """Cash is what was there less what trades took, and a filled order has a fill of its size or less."""
    spent = df.withColumn("spent", F.when(F.col("side") == "buy", F.col("notional_units")).otherwise(-F.col("notional_units")) + F.col("fee_units"))
    total = F.sum("spent").over(Window.partitionBy("account").orderBy("seq"))
    rows = spent.withColumn("want", 200_000_000 - total)
    assert rows.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert rows.where("want <> cash_units or cash_units < 0 or filled > requested or (status = 'filled') <> (filled = requested) or (filled = 0) <> (fee_units = 0)").isEmpty()
    assert {r.status for r in rows.select("status").distinct().collect()} == {"filled", "partially_filled", "rejected"}
    held = F.sum(F.when(F.col("side") == "buy", F.col("filled")).otherwise(-F.col("filled"))).over(Window.partitionBy("account", "code").orderBy("seq"))
    assert rows.withColumn("held", held).where("held < 0").isEmpty()


def check_minutes(df, spark):
    change = F.when(F.col("kind") != "fill", 0).when(F.col("side") == "buy", -F.col("quantity") * F.col("price_units") - F.col("fee_units")).otherwise(F.col("quantity") * F.col("price_units") - F.col("fee_units"))
    moved = F.when(F.col("kind") != "fill", 0).when(F.col("side") == "buy", F.col("quantity")).otherwise(-F.col("quantity"))
    w = Window.partitionBy("account").orderBy("seq")
    rows = df.withColumn("cash", 100_000_000 + F.sum(change).over(w)).withColumn("held", F.sum(moved).over(w))
    assert rows.where("cash <> cash_units or held <> position or cash_units < 0").isEmpty()
    assert {r.kind for r in rows.select("kind").distinct().collect()} >= {"fill", "close"}


def check_fingerprint(df, spark):
    rows = spark.read.parquet(f"{SF}/customer.parquet")
    hashes = [r.h for r in rows.select(F.xxhash64(*rows.columns).alias("h")).collect()]
    xor = 0
    for h in hashes:
        xor ^= h
    assert tuple(df.first()) == (len(hashes), str(sum(hashes)), xor)


def check_selection(df, spark):
    assert [r.candidate for r in df.collect()] and {r.candidate for r in df.collect()} <= {"ridge-0.1", "ridge-10", "ridge-1000"}


BEYOND = {
    "reality_check_white": lambda df, spark: check_reality(df, spark, False),
    "reality_check_spa": lambda df, spark: check_reality(df, spark, True),
    "ledger_cash_simulation": check_cash,
    "simulate_minute_targets": check_minutes,
    "content_fingerprint": check_fingerprint,
    "model_selection": check_selection,
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_queries_beyond_sql_hold_what_must_be_true(spark, name):
    BEYOND[name](QUERIES[name](spark, SF), spark)


def test_every_text_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
