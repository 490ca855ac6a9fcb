"""Queries over futures intents and portfolios, minute studies, budgets, aliases and declared universes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import causal, checks, pit, quality, simulation, statistics, universe
from tidemark.plans.inference import _cdf_sql
from tidemark.plans.series import rounded
from tidemark.plans.trade import _HELD, held
from tidemark.registry import query as register
from tidemark.sources.tables import scan, view_shape

# Futures: suppliers are products, their contract changes every year ----------------------------

_SESSIONS = f"SELECT DISTINCT month AS s FROM ({_HELD}) UNION SELECT MAX(month) + INTERVAL 1 MONTH FROM ({_HELD})"
#: Each target with the one before it and the session in which it is traded.
_MOVES = f"""SELECT account, month, contracts AS t, 'c' || year(month) AS c, COALESCE(LAG(contracts) OVER w, 0) AS h, LAG('c' || year(month)) OVER w AS o, ROW_NUMBER() OVER w - 1 AS n, (SELECT MIN(s) FROM ({_SESSIONS}) WHERE s > month) AS s FROM ({_HELD}) WINDOW w AS (PARTITION BY account ORDER BY month)"""
#: Legs as a list of (contract, signed contracts, offset), without empty ones.
_LEGS = f"""SELECT m.*, CAST(i AS INT) AS leg, legs[i + 1] AS x FROM (SELECT *, list_filter(CASE WHEN o IS NOT NULL AND o <> c THEN [{{'c': o, 'q': -h, 'f': 'close_yesterday'}}, {{'c': c, 'q': t, 'f': 'open'}}] WHEN h * t < 0 THEN [{{'c': c, 'q': -h, 'f': 'close_yesterday'}}, {{'c': c, 'q': t, 'f': 'open'}}]
 ELSE [{{'c': c, 'q': t - h, 'f': CASE WHEN h = 0 OR ABS(t) > ABS(h) THEN 'open' ELSE 'close_yesterday' END}}] END, lambda x: x.q <> 0) AS legs FROM ({_MOVES})) m, LATERAL (SELECT UNNEST(range(len(legs))) AS i)"""


def _targets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = held(spark, d).select(F.col("account").alias("product"), F.col("month").cast("date").alias("session"), F.concat(F.lit("c"), F.year("month").cast("string")).alias("contract"), F.col("contracts").alias("target_quantity"))
    days = rows.select("session").distinct()
    after = days.agg(F.add_months(F.max("session"), 1).alias("session"))
    return rows, days.unionByName(after)


@register("futures_intents", f"SELECT account AS product, CAST(s AS DATE) AS session, CAST(month AS DATE) AS target_session, CAST(n AS INT) AS target_sequence, leg, x.c AS contract, CASE WHEN x.q > 0 THEN 'buy' ELSE 'sell' END AS side, CAST(ABS(x.q) AS BIGINT) AS contracts, x.f AS \"offset\" FROM ({_LEGS})", dates=("session", "target_session"))
def futures_intents(spark: SparkSession, d: str) -> DataFrame:
    targets, days = _targets(spark, d)
    return simulation.futures_intents(targets, days)


_RULES = simulation.FuturesRules(1, 100, (("open", 3), ("close_today", 2), ("close_yesterday", 1)))
_OPENING = 1_000_000_000_000
#: The daily simulation of monthly targets near the settlement price, in one contract: what each month changes.
_DAYS = f"""WITH m AS (SELECT *, COALESCE(LAG(contracts) OVER w, 0) AS p, COALESCE(LAG(settlement_units) OVER w, 0) AS before, settlement_units + (month(month) % 7 - 3) * 100 AS price FROM ({_HELD}) WINDOW w AS (PARTITION BY account ORDER BY month)),
x AS (SELECT *, CASE WHEN p * contracts < 0 THEN ABS(p) ELSE GREATEST(ABS(p) - ABS(contracts), 0) END AS shut, CASE WHEN p * contracts < 0 THEN ABS(contracts) ELSE GREATEST(ABS(contracts) - ABS(p), 0) END AS opened, SIGN(p) AS sp, SIGN(contracts) AS sc FROM m WHERE p <> 0 OR contracts <> 0),
y AS (SELECT account, month, contracts, p, settlement_units, CAST(sp * shut * (price - before) - shut - 3 * opened AS BIGINT) AS traded, CAST(shut + 3 * opened AS BIGINT) AS fee, CAST((p - sp * shut) * (settlement_units - before) + sc * opened * (settlement_units - price) AS BIGINT) AS marked, CAST((ABS(contracts) * settlement_units * 100 + 999999) // 1000000 AS BIGINT) AS margin FROM x)"""


def simulated(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers' monthly targets, each traded in its own month, in one contract a supplier."""
    targets = held(spark, d).withColumn("session", F.col("month").cast("date")).withColumn("price", F.col("settlement_units") + (F.month("month") % 7 - 3) * 100)
    product = F.col("account").cast("string").alias("product")
    # a target of the month before is what is traded in a month
    asked = targets.select(product, F.add_months("session", -1).alias("session"), F.lit("c").alias("contract"), F.col("contracts").alias("target_quantity"))
    days = targets.select(F.explode(F.array("session", F.add_months("session", -1))).alias("session")).distinct()
    prices = targets.select(product.alias("p"), F.col("session").alias("s"), F.col("price").alias("open_units"))
    legs = simulation.futures_intents(asked, days).join(prices, (F.col("product") == F.col("p")) & (F.col("session") == F.col("s"))).withColumn("blocked", F.lit(False))
    marks = targets.select(product, "session", F.lit("c").alias("contract"), "settlement_units")
    return simulation.simulate_futures(legs, marks, _RULES, _OPENING)


def _contributions(spark: SparkSession, d: str) -> DataFrame:
    rows = simulated(spark, d)
    kinds = scan(spark, d, "lineitem").select(F.col("l_suppkey").alias("k")).distinct().select(F.col("k").cast("string").alias("product"), F.concat(F.lit("k"), (F.col("k") % 5).cast("string")).alias("category"))
    return simulation.futures_contributions(rows, kinds, _OPENING)


@register("futures_contributions", f"{_DAYS} SELECT CAST(account AS VARCHAR) AS product, 'k' || account % 5 AS category, CAST(month AS DATE) AS session, traded + marked AS pnl_units, fee AS fee_units, margin AS margin_units, CAST({_OPENING} + SUM(traded + marked) OVER (PARTITION BY account ORDER BY month) AS BIGINT) AS equity_units FROM y", dates=("session",))
def futures_contributions(spark: SparkSession, d: str) -> DataFrame:
    return _contributions(spark, d)


@register("futures_portfolio", f"{_DAYS}, s AS (SELECT month, CAST(SUM(traded + marked) AS BIGINT) AS pnl, CAST(SUM(fee) AS BIGINT) AS fee, CAST(SUM(margin) AS BIGINT) AS margin FROM y GROUP BY 1), t AS (SELECT *, CAST({_OPENING} + SUM(pnl) OVER (ORDER BY month) AS BIGINT) AS equity FROM s) SELECT CAST(month AS DATE) AS session, pnl AS pnl_units, fee AS fee_units, margin AS margin_units, equity AS equity_units, equity - margin AS free_equity_units FROM t", dates=("session",))
def futures_portfolio(spark: SparkSession, d: str) -> DataFrame:
    return simulation.combine_products(_contributions(spark, d), _OPENING, strict=False)


@register("futures_result_cash", f"{_DAYS} SELECT CAST(account AS VARCHAR) AS portfolio_id, CAST(month AS DATE) AS valuation_time, traded AS trade_cash_change_units, marked AS non_trade_cash_change_units, CAST({_OPENING} + SUM(traded + marked) OVER (PARTITION BY account ORDER BY month) AS BIGINT) AS total_cash_units, margin AS margin_units FROM y", dates=("valuation_time",))
def futures_result_cash(spark: SparkSession, d: str) -> DataFrame:
    cash = simulation.project_futures(simulated(spark, d), 1, _OPENING)["cash"]
    return cash.select("portfolio_id", "valuation_time", "trade_cash_change_units", "non_trade_cash_change_units", "total_cash_units", "margin_units")


@register("futures_result_positions", f"{_DAYS} SELECT CAST(account AS VARCHAR) AS portfolio_id, 'c' AS instrument_id, CAST(month AS DATE) AS valuation_time, contracts AS quantity, contracts - p AS trade_quantity_change FROM y", dates=("valuation_time",))
def futures_result_positions(spark: SparkSession, d: str) -> DataFrame:
    return simulation.project_futures(simulated(spark, d), 1, _OPENING)["positions"].select("portfolio_id", "instrument_id", "valuation_time", "quantity", "trade_quantity_change")


@register("futures_result_findings", f"{_DAYS}, c AS (SELECT account, month, CAST({_OPENING} + SUM(traded + marked) OVER (PARTITION BY account ORDER BY month) AS BIGINT) AS total FROM y) SELECT 'cash_running' AS \"check\", account || '@' || CAST(CAST(month AS DATE) AS VARCHAR) AS key, CAST(total AS VARCHAR) AS expected, CAST(total + 1 AS VARCHAR) AS stated FROM c WHERE account % 7 = 0")
def futures_result_findings(spark: SparkSession, d: str) -> DataFrame:
    """A futures result with faults in the cash of every seventh product: those are found, and nothing else."""
    tables = simulation.project_futures(simulated(spark, d), 1, _OPENING)
    wrong = F.when(F.col("portfolio_id").cast("bigint") % 7 == 0, 1).otherwise(0)
    return simulation.verify_result(tables | {"cash": tables["cash"].withColumn("total_cash_units", F.col("total_cash_units") + wrong)})


# Minute studies: users are dealt to candidates, events to labels --------------------------------

_FAMILY = statistics.Family("minute study", tuple(f"c{k}" for k in range(6)), "mean label return")
_PROFILE = statistics.MinuteProfile(_FAMILY, 2000, 5000, 9000, 300, 2)
_LABELS = "SELECT 'c' || (user_id % 5) AS candidate, event_id AS observation_id, event_id AS entry, event_id + 40 AS exit, (event_id * 37 % 101 - 50 + user_id % 5) / 1000.0 AS value FROM events"
_STUDY = f"""WITH l AS ({_LABELS}), t AS (SELECT * FROM l WHERE entry >= 5300 AND entry < 9000 AND exit <= 9000), c AS (SELECT *, value - AVG(value) OVER (PARTITION BY candidate) AS x FROM t),
p AS (SELECT *, x * LAG(x, 1) OVER w AS p1, x * LAG(x, 2) OVER w AS p2 FROM c WINDOW w AS (PARTITION BY candidate ORDER BY entry, observation_id)), g AS (SELECT candidate, COUNT(*) AS n, AVG(value) AS m, SUM(x * x) AS g0, SUM(p1) AS g1, SUM(p2) AS g2 FROM p GROUP BY 1),
z AS (SELECT candidate, n, m, m / SQRT(GREATEST((g0 + 2 * (2.0 / 3) * g1 + 2 * (1.0 / 3) * g2) / n / n, 0)) AS z FROM g WHERE n >= 3 AND GREATEST((g0 + 2 * (2.0 / 3) * g1 + 2 * (1.0 / 3) * g2) / n / n, 0) > 0),
f AS (SELECT 'c' || k AS candidate FROM range(6) r(k)), r AS (SELECT f.candidate, COALESCE(g.n, 0) AS sample_count, z.m AS estimate, CASE WHEN z.z IS NULL THEN 1.0 ELSE 2 * (1 - {_cdf_sql("abs(z.z)")}) END AS raw_p FROM f LEFT JOIN g USING (candidate) LEFT JOIN z USING (candidate)),
k AS (SELECT *, ROW_NUMBER() OVER (ORDER BY raw_p, candidate) AS k FROM r), a AS (SELECT *, LEAST(1.0, MAX(raw_p * (6 - k + 1)) OVER (ORDER BY k)) AS adjusted_p FROM k)"""


def labels(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    return scan(spark, d, "events").select(F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string")).alias("candidate"), e.alias("observation_id"), e.alias("entry"), (e + 40).alias("exit"), ((e * 37 % 101 - 50 + F.col("user_id") % 5) / 1000.0).alias("value"))


@register("minute_statistics", f"{_STUDY} SELECT candidate, sample_count, ROUND(estimate, 8) AS estimate, ROUND(raw_p, 6) AS raw_p, ROUND(adjusted_p, 6) AS adjusted_p, adjusted_p <= 0.05 AS passes_alpha FROM a")
def minute_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Trials of a family of six candidates, one of which has no label."""
    trials, _ = statistics.minute_statistics(labels(spark, d), _PROFILE)
    return rounded(rounded(trials, "estimate", digits=8), "raw_p", "adjusted_p")


@register(
    "minute_statistics_report",
    f"""WITH l AS ({_LABELS}), o AS (SELECT COUNT(*) OVER (PARTITION BY candidate ORDER BY entry RANGE BETWEEN 1 FOLLOWING AND 39 FOLLOWING) AS later FROM l), t AS (SELECT COUNT(DISTINCT candidate) AS c FROM (SELECT candidate FROM l WHERE entry >= 5300 AND entry < 9000 AND exit <= 9000 GROUP BY 1 HAVING COUNT(*) >= 3))
SELECT (SELECT MAX(later) FROM o) AS lag_floor, 40 AS embargo_floor, concat_ws(',', 'search.minute_trial_universe_incomplete', CASE WHEN (SELECT MAX(later) FROM o) > 2 THEN 'statistics.hac_below_floor' END, CASE WHEN (SELECT c FROM t) < 6 THEN 'statistics.minute_sample_invalid' END) AS issue_codes, 'fail' AS status""",
)
def minute_statistics_report(spark: SparkSession, d: str) -> DataFrame:
    return statistics.minute_statistics(labels(spark, d), _PROFILE)[1]


@register("minute_validity", f"{_STUDY} SELECT 'minute_sample_count' AS \"check\", candidate AS key, CAST(sample_count AS VARCHAR) AS expected, CAST(sample_count + 1 AS VARCHAR) AS stated FROM a WHERE candidate IN ('c1', 'c4')")
def minute_validity(spark: SparkSession, d: str) -> DataFrame:
    """A study's trials reported with two wrong counts: those are found, and nothing else."""
    rows = labels(spark, d)
    told, _ = statistics.minute_statistics(rows, _PROFILE)
    wrong = told.withColumn("sample_count", F.col("sample_count") + F.col("candidate").isin("c1", "c4").cast("int"))
    return statistics.minute_validity(wrong, rows, _PROFILE)


@register("inference_intervals", f"WITH c AS (SELECT user_id % 7 AS k, COUNT(*) AS n, AVG(value) AS m, STDDEV_SAMP(value) / SQRT(COUNT(*)) AS se FROM events WHERE value IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1) SELECT k, n AS sample_size, ROUND(m, 6) AS estimate, ROUND(m - 1.959963984540054 * se, 6) AS confidence_low, ROUND(m + 1.959963984540054 * se, 6) AS confidence_high, ROUND(2 * (1 - {_cdf_sql('least(abs(m - 50) / se, 7.9)')}), 6) AS p_value FROM c")
def inference_intervals(spark: SparkSession, d: str) -> DataFrame:
    """Mean values of users by group, with intervals, tested against 50."""
    rows = scan(spark, d, "events").where("value is not null").groupBy((F.col("user_id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("sample_size"), F.avg("value").alias("mean"), (F.stddev_samp("value") / F.sqrt(F.count(F.lit(1)))).alias("standard_error")).where("sample_size > 1")
    out = statistics.inference(rows.withColumn("estimate", F.col("mean") - 50))
    out = out.select("k", "sample_size", F.col("mean").alias("estimate"), (F.col("confidence_low") + 50).alias("confidence_low"), (F.col("confidence_high") + 50).alias("confidence_high"), "p_value")
    return rounded(out, "estimate", "confidence_low", "confidence_high", "p_value")


# Verification, budgets, aliases, universes -------------------------------------------------------


@register("recomputed_totals", "SELECT 'total' AS \"check\", CAST(o_custkey AS VARCHAR) AS key, CAST(n AS VARCHAR) AS expected, CAST(n + 1 AS VARCHAR) AS stated FROM (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1) WHERE o_custkey % 13 = 0")
def recomputed_totals(spark: SparkSession, d: str) -> DataFrame:
    """Stated order counts, some of them wrong, against a second computation in SQL."""
    rows = scan(spark, d, "orders")
    stated = rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total")).withColumn("total", F.col("total") + F.when(F.col("o_custkey") % 13 == 0, 1).otherwise(0))
    again = checks.Workspace({"orders": rows}).sql("SELECT o_custkey, SUM(1) AS total FROM {orders} GROUP BY o_custkey")
    return checks.recomputed(stated, again, ["o_custkey"])


@register("minute_context", "SELECT 'minute_bar' AS \"check\", user_id || ':' || event_id AS key FROM events WHERE event_id % 13 = 0 UNION ALL SELECT 'minute_price', user_id || ':' || event_id FROM events WHERE event_id % 13 <> 0 AND event_id % 7 = 0 UNION ALL SELECT 'minute_target', user_id || ':' || event_id FROM events WHERE event_id % 13 <> 0 AND event_id % 11 = 0")
def minute_context(spark: SparkSession, d: str) -> DataFrame:
    """Events as bars, each traded once, with fills outside bars, at wrong prices and before their target: those are found."""
    e, c = scan(spark, d, "events"), F.col
    when = lambda k, a, b: F.when(c("event_id") % k == 0, a).otherwise(b)
    base = e.select(c("user_id").alias("account"), c("event_id").alias("seq"), "event_id", c("event_id").cast("string").alias("code"), c("ts").alias("bar_start"), (c("ts") + F.expr("interval 1 minute")).alias("dt"), (c("event_id") % 100 + 100).alias("open_units"))
    targets = base.select("account", "code", when(11, c("bar_start") + F.expr("interval 5 minutes"), c("bar_start")).alias("decision_time"))
    fills = base.select("account", "seq", "code", when(13, c("dt") + F.expr("interval 1 day"), c("dt")).alias("at"), F.lit("buy").alias("side"), (c("open_units") + when(7, 3, 1)).alias("price_units"))
    return checks.minute_context(base.drop("event_id", "seq"), targets, fills, 1).select("check", "key")


@register("byte_budget", "SELECT n_nationkey, n_name FROM nation")
def byte_budget(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "nation").select("n_nationkey", "n_name")
    quality.preflight(rows, max_bytes=1 << 20)
    return quality.within_budget(rows, 1000, 1 << 16)


@register("concatenated", "SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer")
def concatenated(spark: SparkSession, d: str) -> DataFrame:
    parts = [scan(spark, d, t).select(F.col(f"{p}_{k}key").alias("id"), F.col(f"{p}_name").alias("name")) for t, p, k in (("supplier", "s", "supp"), ("customer", "c", "cust"))]
    return quality.concatenate(parts, 1 << 30)


@register("alias_lookup", "SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'old-' ELSE 'new-' END || o_custkey AS instrument FROM orders")
def alias_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Customers' names changed in 1996: each order finds the one of its day."""
    turn = F.lit("1996-01-01").cast("date")
    keys = scan(spark, d, "customer").select(F.col("c_custkey").alias("alias"))
    span = lambda tag, a, b: F.struct(F.concat(F.lit(tag), F.col("alias").cast("string")).alias("instrument"), a.cast("date").alias("start"), b.cast("date").alias("end"))
    aliases = keys.select("alias", F.explode(F.array(span("old-", F.lit("1980-01-01"), F.date_sub(turn, 1)), span("new-", turn, F.lit(None)))).alias("x")).select("alias", "x.*")
    rows = scan(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return pit.resolve_alias(rows, aliases, "o_custkey", "day").select("o_orderkey", "instrument")


@register("universe_plan", "SELECT CAST(c_custkey AS VARCHAR) AS instrument, c_mktsegment = 'BUILDING' AND c_nationkey % 3 <> 0 AS included FROM customer")
def universe_plan(spark: SparkSession, d: str) -> DataFrame:
    """A declared universe: customers of one segment but for those of every third nation."""
    rows = scan(spark, d, "customer")
    attributes = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("third"), (F.col("c_nationkey") % 3 == 0).cast("string"))
    all_ = rows.select(F.col("c_custkey").cast("string").alias("instrument"), F.lit(True).alias("included"), F.lit(universe.INCLUDED).alias("reason"), attributes.alias("attributes"))
    steps = (
        universe.Step("result", "difference", ("segment", "third")), universe.Step("segment", "filter", ("clocked",), ("segment", "eq", "BUILDING")),
        universe.Step("third", "filter", ("clocked",), ("third", "is_true")), universe.Step("clocked", "as_of", ("customers",), ("1998-12-31",)), universe.Step("customers", "base", ("facts",)),
    )
    return universe.evaluate(steps, {"facts": all_}, "1998-12-31").select("instrument", "included")


@register("decoded_metrics", "SELECT 'data.row_count' AS metric_ref, CAST(COUNT(*) AS DOUBLE) AS value, COUNT(*) AS sample_size FROM events")
def decoded_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = causal.metric_rows(scan(spark, d, "events"), [("data.row_count", F.count(F.lit(1)), "rows")], "ts", "ts")
    return causal.decode_metrics(rows, ["data.row_count", "minute.row_count"])


@register("visible_facts", "SELECT o_orderkey, COUNT(l_orderkey) AS facts_read, MAX(l_shipdate) AS last_available, CAST(COALESCE(SUM(l_quantity), 0) AS BIGINT) AS seen FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate <= o_orderdate + INTERVAL 60 DAY GROUP BY 1")
def visible_facts(spark: SparkSession, d: str) -> DataFrame:
    """What each order's decision, sixty days after it, may read of its lines."""
    decisions = scan(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").alias("key"), (F.col("o_orderdate") + F.expr("interval 60 days")).alias("decided"))
    facts = scan(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_shipdate").alias("shipped"), "l_quantity")
    out = causal.visible_to(decisions, facts, ["key"], "decided", "shipped")
    return out.select("o_orderkey", "facts_read", "last_available", F.aggregate("facts", F.lit(0.0), lambda a, x: a + x["l_quantity"]).cast("bigint").alias("seen"))


@register("view_shapes", "SELECT * FROM (VALUES ('a', 'projection'), ('b', 'union_all'), ('c', 'join'), ('d', 'parquet')) v(view, shape)")
def view_shapes(spark: SparkSession, d: str) -> DataFrame:
    texts = {"a": "SELECT a, b AS c FROM t", "b": "SELECT a FROM t UNION ALL SELECT a FROM u", "c": "SELECT t.a FROM t JOIN u ON t.a = u.a", "d": "SELECT a FROM parquet.`/data/t`"}
    return spark.createDataFrame([(n, view_shape(spark, x)) for n, x in texts.items()], "view string, shape string")
