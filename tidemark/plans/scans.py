"""Queries over bounded scans, filters, orders and gates."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality, query
from tidemark.operators.query import Filter, Request
from tidemark.registry import query as register
from tidemark.schema import Dataset, Field
from tidemark.sources.tables import discover, json_array_rows, scan

LINES = Dataset(
    "lines",
    (
        Field("order_key", "integer", "l_orderkey"), Field("line", "integer", "l_linenumber"), Field("part_key", "integer", "l_partkey"), Field("supplier_key", "integer", "l_suppkey"),
        Field("quantity", "number", "l_quantity"), Field("price", "decimal", "l_extendedprice"), Field("flag", "string", "l_returnflag"), Field("shipped", "date", "l_shipdate"),
    ),
    key=("order_key", "line"),
    event_time="shipped",
)
EVENTS = Dataset("events", (Field("event_id", "integer"), Field("user", "string", "user_id"), Field("kind", "string", "event_type"), Field("at", "instant", "ts"), Field("value", "number")), key=("event_id",), event_time="at")
ORDERS = Dataset("orders", (Field("order_key", "integer", "o_orderkey"), Field("customer", "string", "o_custkey"), Field("status", "string", "o_orderstatus"), Field("total", "number", "o_totalprice"), Field("ordered", "date", "o_orderdate")), key=("order_key",), event_time="ordered")


def lines(spark, d, *filters, columns=("order_key", "line", "shipped", "quantity")) -> DataFrame:
    return Request(LINES, columns, filters=filters).plan(scan(spark, d, "lineitem"))


@register("scan_typed_projection", "SELECT CAST(l_orderkey AS BIGINT) AS order_key, CAST(l_linenumber AS BIGINT) AS line, CAST(l_extendedprice AS DECIMAL(38,9)) AS price, CAST(l_shipdate AS DATE) AS shipped FROM lineitem", dates=("shipped",), decimals=("price",))
def scan_typed_projection(spark: SparkSession, d: str) -> DataFrame:
    return lines(spark, d, columns=("order_key", "line", "shipped", "price"))


_COLS = "l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line, l_quantity AS quantity, CAST(l_shipdate AS DATE) AS shipped"
for _name, _filter, _sql in (
    ("filter_eq", Filter("quantity", "eq", (7.0,)), "l_quantity = 7"),
    ("filter_ne", Filter("quantity", "ne", (7.0,)), "l_quantity <> 7"),
    ("filter_in", Filter("line", "in", (3, 1, 3)), "l_linenumber IN (1, 3)"),
    ("filter_range", Filter("quantity", "range", (10.0, 12.0)), "l_quantity BETWEEN 10 AND 12"),
    ("filter_compare_lt", Filter("quantity", "lt", (3.0,)), "l_quantity < 3"),
    ("filter_compare_le", Filter("quantity", "le", (3.0,)), "l_quantity <= 3"),
    ("filter_compare_gt", Filter("quantity", "gt", (48.0,)), "l_quantity > 48"),
    ("filter_compare_ge", Filter("quantity", "ge", (48.0,)), "l_quantity >= 48"),
    ("filter_is_null", Filter("quantity", "is_null"), "l_quantity IS NULL"),
    ("filter_is_valid", Filter("quantity", "is_valid"), "l_quantity IS NOT NULL"),
):
    register(_name, f"SELECT {_COLS} FROM lineitem WHERE {_sql}", dates=("shipped",))(lambda spark, d, f=_filter: lines(spark, d, f))


@register("date_range", "SELECT CAST(o_orderkey AS BIGINT) AS order_key, CAST(o_orderdate AS DATE) AS ordered, o_totalprice AS total FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-05-31'", dates=("ordered",))
def date_range(spark: SparkSession, d: str) -> DataFrame:
    return Request(ORDERS, ("order_key", "ordered", "total"), start=date(1997, 3, 1), end=date(1997, 5, 31)).plan(scan(spark, d, "orders"))


@register("instant_range", 'SELECT event_id, ts AS "at", value FROM events WHERE ts >= TIMESTAMP \'2024-01-03 09:30:00\' AND ts < TIMESTAMP \'2024-01-07 15:00:00\' AND ts <= TIMESTAMP \'2024-01-06 12:00:00\'')
def instant_range(spark: SparkSession, d: str) -> DataFrame:
    return Request(EVENTS, ("event_id", "at", "value"), start=datetime(2024, 1, 3, 9, 30), end=datetime(2024, 1, 7, 15), as_of=datetime(2024, 1, 6, 12)).plan(scan(spark, d, "events"))


@register("universe_filter", "SELECT event_id, ts AS \"at\", CAST(user_id AS VARCHAR) AS user FROM events WHERE user_id IN (3, 7, 11)")
def universe_filter(spark: SparkSession, d: str) -> DataFrame:
    return Request(EVENTS, ("event_id", "user", "at"), universe=("7", "3", "11", "3"), instrument="user").plan(scan(spark, d, "events"))


@register("universe_semi_join", "SELECT o_orderkey AS order_key, o_custkey AS customer FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def universe_semi_join(spark: SparkSession, d: str) -> DataFrame:
    members = scan(spark, d, "customer").where("c_mktsegment = 'MACHINERY'").select("c_custkey")
    orders = scan(spark, d, "orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer"))
    return query.universe_filter(orders, "customer", members)


@register("stable_sort_limit", "SELECT event_id, ts AS \"at\", value FROM events ORDER BY event_id ASC, value DESC NULLS LAST LIMIT 25")
def stable_sort_limit(spark: SparkSession, d: str) -> DataFrame:
    return Request(EVENTS, ("event_id", "at", "value"), order=(("event_id", "asc"), ("value", "desc")), limit=25).plan(scan(spark, d, "events"))


@register("row_budget", "SELECT r_regionkey, r_name FROM region")
def row_budget(spark: SparkSession, d: str) -> DataFrame:
    return query.within_rows(scan(spark, d, "region"), 1000)


@register("scope_statistics", "SELECT COUNT(*) AS row_count, MAX(strlen(CAST(c_name AS VARCHAR))) AS c_name_bytes, MAX(strlen(CAST(c_mktsegment AS VARCHAR))) AS c_mktsegment_bytes FROM customer")
def scope_statistics(spark: SparkSession, d: str) -> DataFrame:
    return query.scope_statistics(scan(spark, d, "customer"), ["c_name", "c_mktsegment"])


@register("json_array_rows", "SELECT event_id, CAST(ts AS DATE) AS day, unnest([event_type, 'u' || CAST(user_id % 3 AS VARCHAR)]) AS tag, kind FROM events, (VALUES ('a'), ('b')) k(kind)", dates=("day",))
def json_rows(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit('["'), "event_type", F.lit('","u'), (F.col("user_id") % 3).cast("string"), F.lit('"]'))
    rows = scan(spark, d, "events").select("event_id", F.col("ts").cast("string").alias("day"), text.alias("tags"))
    return json_array_rows(rows, ["event_id"], "tags", "tag", kinds=["a", "b"], dates=["day"])


_KINDS = "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float' WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE CASE WHEN column_type LIKE 'TIMESTAMP%' THEN 'timestamp_ntz' ELSE lower(column_type) END END"


@register("schema_discovery", " UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(ROW_NUMBER() OVER () - 1 AS INTEGER) AS position, column_name, {_KINDS} AS data_type FROM (DESCRIBE SELECT * FROM {t})" for t in ("orders", "lineitem", "events")))
def schema_discovery(spark: SparkSession, d: str) -> DataFrame:
    return discover(spark, d, ["orders", "lineitem", "events"])


@register("key_findings", "SELECT l_orderkey, l_linenumber, COUNT(*) AS rows, 'duplicate_key' AS finding FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def key_findings(spark: SparkSession, d: str) -> DataFrame:
    return quality.key_findings(scan(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("quality_gate", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    orders = scan(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return quality.quality_gate(orders, {"o_orderkey": "bigint", "o_totalprice": "double"}, ["o_orderkey"], ["o_custkey"], F.col("o_totalprice") >= 0)


@register("observation_facts", "SELECT 'orders' AS dataset, COUNT(*) AS row_count FROM orders UNION ALL SELECT 'events', COUNT(*) FROM events UNION ALL SELECT 'part', COUNT(*) FROM part")
def observation_facts(spark: SparkSession, d: str) -> DataFrame:
    return quality.observation_facts({n: scan(spark, d, n) for n in ("orders", "events", "part")})


@register("content_fingerprint")
def content_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return quality.content_fingerprint(scan(spark, d, "customer"))


@register("publication_summary", "SELECT event_type AS factor_id, COUNT(*) AS rows, MIN(CAST(ts AS DATE)) AS first_date, MAX(CAST(ts AS DATE)) AS last_date, COUNT(DISTINCT user_id) AS codes FROM events GROUP BY 1", dates=("first_date", "last_date"))
def publication_summary(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.sources.store import publication_summary as summary

    factors = scan(spark, d, "events").select(F.col("event_type").alias("factor_id"), F.col("ts").cast("date").alias("date"), F.col("user_id").alias("code"), F.lit("published").alias("reason"))
    return summary(factors)[0]
