"""Queries over trading rules, ledgers, cost analysis and conservation checks.

Orders and line items play orders and fills: a customer is an account, a part an instrument, and
money is in cents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import checks, ledger, simulation, trading
from tidemark.registry import query as register
from tidemark.sources.store import kept
from tidemark.sources.tables import scan

POLICY = trading.CashPolicy()

_LINE = "ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus)"
#: One order for each line: side by return flag, prices around the part's retail price.
_ORDERS = f"""SELECT l_orderkey * 100 + {_LINE} AS id, o_custkey AS account, l_partkey AS code, CASE WHEN l_returnflag = 'R' THEN 'sell' ELSE 'buy' END AS side, CAST(l_quantity * 20 AS BIGINT) AS quantity,
 l_suppkey % 37 = 0 AS paused, CAST(ROUND(p_retailprice * 100) AS BIGINT) AS open_units, CAST(ROUND(p_retailprice * 100) AS BIGINT) + (l_suppkey % 5) * 100 AS high_limit_units, CAST(ROUND(p_retailprice * 100) AS BIGINT) - (l_partkey % 4) * 100 AS low_limit_units,
 CASE WHEN l_linenumber % 3 = 0 THEN CAST(ROUND(p_retailprice * 100) AS BIGINT) + (l_partkey % 7) - 3 END AS limit_units, CAST(l_partkey * 10 % 900 AS BIGINT) AS sellable, o_orderdate AS day
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey"""


def orders(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    # orders last: their join and the window share an exchange
    rows = scan(spark, d, "lineitem").join(scan(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey")).join(scan(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    price = F.round(F.col("p_retailprice") * 100).cast("bigint")
    return rows.select(
        (F.col("l_orderkey") * 100 + F.row_number().over(w)).alias("id"), F.col("o_custkey").alias("account"), F.col("l_partkey").alias("code"), F.when(F.col("l_returnflag") == "R", "sell").otherwise("buy").alias("side"), (F.col("l_quantity") * 20).cast("bigint").alias("quantity"),
        (F.col("l_suppkey") % 37 == 0).alias("paused"), price.alias("open_units"), (price + (F.col("l_suppkey") % 5) * 100).alias("high_limit_units"), (price - (F.col("l_partkey") % 4) * 100).alias("low_limit_units"),
        F.when(F.col("l_linenumber") % 3 == 0, price + F.col("l_partkey") % 7 - 3).alias("limit_units"), (F.col("l_partkey") * 10 % 900).alias("sellable"), F.col("o_orderdate").alias("day"),
    )


@register(
    "tradability",
    f"""SELECT id, CASE WHEN quantity < 100 THEN 'below_lot_size' WHEN paused THEN 'suspended' WHEN side = 'buy' AND open_units >= high_limit_units THEN 'limit_up_buy_blocked' WHEN side = 'sell' AND open_units <= low_limit_units THEN 'limit_down_sell_blocked'
 WHEN side = 'sell' AND sellable < quantity THEN 't1_sell_blocked' END AS reason_code FROM ({_ORDERS})""",
)
def tradability(spark: SparkSession, d: str) -> DataFrame:
    rows = orders(spark, d).withColumnsRenamed({"open_units": "open", "high_limit_units": "high_limit", "low_limit_units": "low_limit"})
    return trading.tradability(rows).select("id", "reason_code")


@register(
    "cash_reject_reason",
    f"""WITH o AS ({_ORDERS}), x AS (SELECT *, open_units + CASE WHEN side = 'buy' THEN 1 ELSE -1 END AS price FROM o)
SELECT id, price AS execution_units, CASE WHEN quantity % 100 <> 0 AND NOT (side = 'sell' AND quantity % 100 = sellable % 100) THEN 'invalid_lot' WHEN paused THEN 'suspended' WHEN side = 'buy' AND price >= high_limit_units THEN 'limit_up_buy_blocked'
 WHEN side = 'sell' AND price <= low_limit_units THEN 'limit_down_sell_blocked' WHEN side = 'buy' AND price > limit_units THEN 'limit_price_not_reached' WHEN side = 'sell' AND price < limit_units THEN 'limit_price_not_reached' WHEN side = 'sell' AND sellable < quantity THEN 't1_sell_blocked' END AS reject_reason FROM x""",
)
def cash_reject_reason(spark: SparkSession, d: str) -> DataFrame:
    return trading.reject_reason(orders(spark, d), POLICY).select("id", "execution_units", "reject_reason")


@register(
    "cash_fees",
    f"""SELECT id, GREATEST(500, (n * 300 + 999999) // 1000000) + (n * 10 + 999999) // 1000000 + CASE WHEN side = 'sell' THEN (n * 1000 + 999999) // 1000000 ELSE 0 END AS fee_units FROM (SELECT id, side, quantity * open_units AS n FROM ({_ORDERS}))""",
)
def cash_fees(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).select("id", trading.fee_units(F.col("side"), F.col("quantity") * F.col("open_units"), POLICY).alias("fee_units"))


@register("target_quantity", "SELECT p_partkey, CAST(FLOOR((100000000 * CAST(p_size * 1000 AS HUGEINT) // 1000000) / ROUND(p_retailprice * 100)) AS BIGINT) // 100 * 100 AS quantity FROM part")
def target_quantity(spark: SparkSession, d: str) -> DataFrame:
    price = F.round(F.col("p_retailprice") * 100).cast("bigint")
    return scan(spark, d, "part").select("p_partkey", trading.target_quantity(F.lit(100_000_000).cast("bigint"), (F.col("p_size") * 1000).cast("bigint"), price, 100).alias("quantity"))


@register("net_asset_value", f"WITH p AS (SELECT account, CAST(SUM(quantity * open_units) AS BIGINT) AS market_value_units FROM ({_ORDERS}) WHERE side = 'buy' GROUP BY 1), c AS (SELECT c_custkey AS account, CAST(ROUND(c_acctbal * 100) AS BIGINT) AS cash_units FROM customer) SELECT account, COALESCE(cash_units, 0) AS cash_units, COALESCE(market_value_units, 0) AS market_value_units, COALESCE(cash_units, 0) + COALESCE(market_value_units, 0) AS nav_units FROM c FULL JOIN p USING (account)")
def net_asset_value(spark: SparkSession, d: str) -> DataFrame:
    cash = scan(spark, d, "customer").select(F.col("c_custkey").alias("account"), F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cash_units"))
    held = orders(spark, d).where("side = 'buy'").select("account", "quantity", F.col("open_units").alias("price_units"))
    return trading.net_asset_value(cash, held, ["account"])


@register("participation_cap", "SELECT id, GREATEST(quantity * 25 * 120000 // 1000000 - sellable, 0) // 100 * 100 AS room FROM (" + _ORDERS + ")")
def participation_cap(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).select("id", trading.participation_cap(F.col("quantity") * 25, 120_000, F.col("sellable"), 100).alias("room"))


# Futures: suppliers as accounts, parts as contracts, months as settlement days -----------------

_HELD = "SELECT l_suppkey AS account, date_trunc('month', l_shipdate) AS month, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END) AS BIGINT) AS contracts, CAST(ROUND(MAX(l_extendedprice) * 100) AS BIGINT) AS settlement_units FROM lineitem GROUP BY 1, 2"


def held(spark: SparkSession, d: str) -> DataFrame:
    month = F.make_timestamp_ntz(F.year("l_shipdate"), F.month("l_shipdate"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return scan(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("account"), month.alias("month")).agg(F.sum(signed).cast("bigint").alias("contracts"), F.round(F.max("l_extendedprice") * 100).cast("bigint").alias("settlement_units"))


@register("futures_margin", f"SELECT account, month, (ABS(contracts) * settlement_units * 5 * 120000 + 999999) // 1000000 AS margin_units FROM ({_HELD})")
def futures_margin(spark: SparkSession, d: str) -> DataFrame:
    return held(spark, d).select("account", "month", trading.margin_units(F.col("contracts"), F.col("settlement_units"), F.lit(5).cast("bigint"), F.lit(120_000).cast("bigint")).alias("margin_units"))


@register("futures_settlement", f"SELECT account, month, COALESCE(LAG(settlement_units) OVER w, settlement_units) AS previous_settlement_units, COALESCE(LAG(contracts) OVER w, 0) * (settlement_units - COALESCE(LAG(settlement_units) OVER w, settlement_units)) * 5 AS pnl_units FROM ({_HELD}) WINDOW w AS (PARTITION BY account ORDER BY month)")
def futures_settlement(spark: SparkSession, d: str) -> DataFrame:
    return trading.settle_day(held(spark, d).withColumn("multiplier", F.lit(5)), ["account"], "month").select("account", "month", "previous_settlement_units", "pnl_units")


@register("futures_fees", f"SELECT account, month, ABS(contracts) * CASE WHEN contracts > 100 THEN 12 WHEN contracts < 0 THEN 3 ELSE 7 END AS fee_units FROM ({_HELD})")
def futures_fees(spark: SparkSession, d: str) -> DataFrame:
    offset = F.when(F.col("contracts") > 100, "open").when(F.col("contracts") < 0, "close_today").otherwise("close_yesterday")
    return held(spark, d).select("account", "month", trading.futures_fee(offset, F.col("contracts"), {"open": 12, "close_today": 3, "close_yesterday": 7}).alias("fee_units"))


@register("margin_calls", f"SELECT account, month FROM (SELECT *, contracts * 100000 AS equity, (ABS(contracts) * settlement_units * 80000 + 999999) // 1000000 AS need FROM ({_HELD})) WHERE equity < need")
def margin_calls(spark: SparkSession, d: str) -> DataFrame:
    need = trading.margin_units(F.col("contracts"), F.col("settlement_units"), F.lit(1).cast("bigint"), F.lit(80_000).cast("bigint"))
    return trading.margin_calls(held(spark, d).withColumn("equity_units", F.col("contracts") * 100_000).withColumn("maintenance_units", need)).select("account", "month")


@register(
    "contract_mapping",
    "WITH m AS (SELECT l_suppkey AS continuous, CAST(l_shipdate AS DATE) AS signal_date, MAX(l_partkey) AS contract FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-12-31' GROUP BY 1, 2) SELECT continuous, signal_date, contract FROM m",
    dates=("signal_date",),
)
def contract_mapping(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("continuous"), F.col("l_shipdate").cast("date").alias("signal_date")).agg(F.max("l_partkey").alias("contract"), F.max("l_shipdate").alias("available")).withColumn("roll", F.lit(False))
    clock = F.lit("1998-12-31").cast("timestamp_ntz")
    return trading.contract_at(rows.where(F.col("available") <= clock).select("continuous", "signal_date"), rows, clock).select("continuous", "signal_date", "contract")


@register(
    "roll_legs",
    f"""WITH h AS (SELECT account, month, contracts, 'c' || CAST(month(month) // 4 AS VARCHAR) AS contract FROM ({_HELD})), r AS (SELECT account, month, LAG(contract) OVER w AS oc, contract AS nc, COALESCE(LAG(contracts) OVER w, 0) AS held, contracts AS target FROM h WINDOW w AS (PARTITION BY account ORDER BY month)),
l AS (SELECT account, month, 1 AS k, oc AS contract, -held AS n, 'close_yesterday' AS "offset" FROM r WHERE oc <> nc UNION ALL SELECT account, month, 2, nc, target, 'open' FROM r WHERE oc <> nc OR oc IS NULL
 UNION ALL SELECT account, month, 1, nc, -held, 'close_today' FROM r WHERE oc = nc AND held * target < 0 UNION ALL SELECT account, month, 2, nc, target, 'open' FROM r WHERE oc = nc AND held * target < 0
 UNION ALL SELECT account, month, 1, nc, target - held, CASE WHEN held = 0 OR ABS(target) > ABS(held) THEN 'open' ELSE 'close_today' END FROM r WHERE oc = nc AND held * target >= 0)
SELECT account, month, ROW_NUMBER() OVER (PARTITION BY account, month ORDER BY k) - 1 AS leg, contract, CASE WHEN n > 0 THEN 'buy' ELSE 'sell' END AS side, ABS(n) AS contracts, "offset" FROM l WHERE n <> 0""",
)
def roll_legs(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("account").orderBy("month")
    rows = held(spark, d).withColumn("contract", F.concat(F.lit("c"), F.floor(F.month("month") / 4).cast("string")))
    rows = rows.select("account", "month", F.lag("contract").over(w).alias("old_contract"), F.col("contract").alias("new_contract"), F.lit(True).alias("roll"), F.coalesce(F.lag("contracts").over(w), F.lit(0)).alias("held"), F.col("contracts").alias("target"))
    return trading.decompose_roll(rows).select("account", "month", "leg", "contract", "side", "contracts", "offset")


@register("rule_lookup", "SELECT o_orderkey, CASE WHEN o_orderdate <= TIMESTAMP '1997-12-31' THEN 100 ELSE 120 END AS margin FROM orders")
def rule_lookup(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame([("x", "1980-01-01", "1997-12-31", "1980-01-01", 100), ("x", "1998-01-01", None, "1997-12-01", 120), ("x", "1998-01-01", None, "2030-01-01", 999)], "market string, valid_from string, valid_to string, available string, margin int")
    rules = rules.select("market", F.col("valid_from").cast("date").alias("valid_from"), F.col("valid_to").cast("date").alias("valid_to"), F.col("available").cast("date").alias("available"), "margin")
    facts = scan(spark, d, "orders").select("o_orderkey", F.lit("x").alias("market"), F.col("o_orderdate").cast("date").alias("day"))
    return trading.rule_at(facts, rules, ["market"], "day", F.lit("2020-01-01").cast("date")).select("o_orderkey", "margin")


# Corporate actions -----------------------------------------------------------------------------

_KINDS = "['cash_dividend', 'stock_dividend', 'split', 'reverse_split', 'rights', 'delisting_cash', 'code_change']"


@register(
    "corporate_actions",
    f"""WITH a AS (SELECT p_partkey AS id, ({_KINDS})[1 + p_partkey % 7] AS kind, CAST(p_size * 130 AS BIGINT) AS held, CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE p_partkey % 1000 * 17 END AS micro, CASE WHEN p_partkey % 7 = 3 THEN 1 ELSE 11 END AS num, 10 AS den, CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS ex, p_partkey % 4 = 0 AS later FROM part),
x AS (SELECT *, CASE WHEN kind = 'cash_dividend' AND micro <> 0 THEN CAST(FLOOR(held * micro / 10000 + 0.5) AS BIGINT) WHEN kind IN ('cash_dividend', 'delisting_cash') THEN held * 25 WHEN kind = 'rights' THEN -ex * 800 ELSE 0 END AS cash,
 CASE WHEN kind IN ('stock_dividend', 'split', 'reverse_split') THEN held * num // den - held WHEN kind = 'rights' THEN ex WHEN kind = 'delisting_cash' THEN -held ELSE 0 END AS shares FROM a WHERE kind <> 'code_change' AND (kind <> 'rights' OR ex IS NOT NULL))
SELECT id, kind, CASE WHEN kind = 'cash_dividend' AND later AND cash <> 0 THEN 0 ELSE cash END AS cash_delta_units, CASE WHEN kind = 'cash_dividend' AND later THEN cash ELSE 0 END AS cash_receivable_units,
 CASE WHEN kind IN ('stock_dividend', 'split') AND shares > 0 AND later THEN 0 ELSE shares END AS sellable_delta, CASE WHEN kind IN ('stock_dividend', 'split') AND shares > 0 AND later THEN shares ELSE 0 END AS entitlement_quantity FROM x""",
)
def corporate_actions(spark: SparkSession, d: str) -> DataFrame:
    p, size = F.col("p_partkey"), F.col("p_size").cast("bigint")
    kinds = F.array(*[F.lit(k) for k in ("cash_dividend", "stock_dividend", "split", "reverse_split", "rights", "delisting_cash", "code_change")])
    day = lambda t: F.lit(t).cast("date")
    rows = scan(spark, d, "part").select(
        p.alias("id"), F.element_at(kinds, (p % 7 + 1).cast("int")).alias("kind"), (size * 130).alias("held"), F.lit(25).cast("bigint").alias("cash_per_share_units"), F.when(p % 2 == 0, 0).otherwise(p % 1000 * 17).cast("bigint").alias("cash_per_share_micro"),
        F.when(p % 7 == 3, 1).otherwise(11).cast("bigint").alias("ratio_numerator"), F.lit(10).cast("bigint").alias("ratio_denominator"), F.lit(800).cast("bigint").alias("exercise_price_units"), F.when(p % 3 != 0, size).alias("exercised"),
        day("2024-01-02").alias("announced"), day("2024-01-05").alias("effective_date"), F.when(p % 4 == 0, day("2024-02-01")).otherwise(day("2024-01-05")).alias("pay_date"),
    )
    return trading.compile_actions(rows, day("2024-01-05")).select("id", "kind", "cash_delta_units", "cash_receivable_units", "sellable_delta", "entitlement_quantity")


@register("order_transitions", f"SELECT id, CASE WHEN quantity <= 500 THEN 'filled' ELSE 'partially_filled' END AS next_status, LEAST(quantity, 500) AS next_filled FROM ({_ORDERS})")
def order_transitions(spark: SparkSession, d: str) -> DataFrame:
    rows = orders(spark, d).select("id", "quantity", F.lit("accepted").alias("status"), F.lit("fill").alias("action"), F.lit(0).cast("bigint").alias("filled"), F.least("quantity", F.lit(500)).alias("fill_quantity"))
    return trading.transition(rows).select("id", "next_status", "next_filled")


# Cost analysis ---------------------------------------------------------------------------------

_FILLS = f"SELECT id, account, code, side, quantity, open_units + id % 13 - 6 AS execution_units, open_units AS decision_units, CASE WHEN id % 97 <> 0 THEN open_units + id % 7 - 3 END AS arrival_units, quantity * 20 AS capacity, 500 + id % 50 AS fee_units, day FROM ({_ORDERS})"
_COSTS = f"""SELECT *, (CASE WHEN side = 'buy' THEN 1 ELSE -1 END) * (execution_units - decision_units) * quantity AS shortfall_units, (CASE WHEN side = 'buy' THEN 1 ELSE -1 END) * (execution_units - decision_units) * quantity + fee_units AS implementation_shortfall_units,
 CASE WHEN arrival_units IS NULL THEN 'not_computable' ELSE 'computed' END AS liquidity_status, CASE WHEN arrival_units IS NOT NULL THEN quantity * 1000000 // capacity END AS participation_ppm,
 CAST(FLOOR(arrival_units * 5 / 10000 + 0.5) AS BIGINT) * quantity AS spread_units, CAST(FLOOR(arrival_units * 10 / 10000 + 0.5) AS BIGINT) * quantity AS impact_units FROM ({_FILLS})"""


def costs(spark: SparkSession, d: str) -> DataFrame:
    rows = orders(spark, d).select(
        "id", "account", "code", "side", "quantity", (F.col("open_units") + F.col("id") % 13 - 6).alias("execution_units"), F.col("open_units").alias("decision_units"), F.when(F.col("id") % 97 != 0, F.col("open_units") + F.col("id") % 7 - 3).alias("arrival_units"),
        (F.col("quantity") * 20).alias("capacity"), (F.lit(500) + F.col("id") % 50).alias("fee_units"), "day",
    )
    return trading.fill_costs(rows, trading.CostPolicy())


@register("tca_fills", f"SELECT id, shortfall_units, implementation_shortfall_units, liquidity_status, participation_ppm, spread_units, impact_units FROM ({_COSTS})")
def tca_fills(spark: SparkSession, d: str) -> DataFrame:
    return costs(spark, d).select("id", "shortfall_units", "implementation_shortfall_units", "liquidity_status", "participation_ppm", "spread_units", "impact_units")


for _name, _keys in (("tca_orders", ["account", "code"]), ("tca_daily", ["day"]), ("tca_overall", [])):
    _head = "".join(f"{k}, " for k in _keys)
    _tail = f" GROUP BY {', '.join(_keys)}" if _keys else ""
    register(
        _name,
        f"""SELECT {_head}COUNT(*) AS fill_count, CAST(SUM(shortfall_units) AS BIGINT) AS shortfall_units, CAST(SUM(fee_units) AS BIGINT) AS fee_units, CAST(SUM(implementation_shortfall_units) AS BIGINT) AS implementation_shortfall_units, CASE WHEN bool_and(liquidity_status = 'computed') THEN 'computed' ELSE 'not_computable' END AS liquidity_status,
 CASE WHEN bool_and(liquidity_status = 'computed') THEN CAST(SUM(spread_units) AS BIGINT) END AS spread_units, CASE WHEN bool_and(liquidity_status = 'computed') THEN CAST(SUM(impact_units) AS BIGINT) END AS impact_units FROM ({_COSTS}){_tail}""",
    )(lambda spark, d, k=_keys: trading.cost_rollup(costs(spark, d), k))


# Conservation checks: results made from the line items, with errors planted by id --------------


def result_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    rows = orders(spark, d)
    fills = rows.select(
        F.col("id").alias("fill_id"), F.col("id").alias("order_id"), F.col("code").alias("instrument_id"), "side", "quantity", F.col("open_units").alias("execution_price_units"), F.lit(1).alias("contract_multiplier"),
        (F.col("quantity") * F.col("open_units") + F.when(F.col("id") % 101 == 0, 1).otherwise(0)).alias("notional_units"), (F.lit(500) + F.col("id") % 50).alias("fee_units"), F.col("account").alias("portfolio_id"), F.col("day").alias("session"),
    )
    wanted = rows.select(F.col("id").alias("order_id"), F.col("code").alias("instrument_id"), F.col("quantity").alias("requested_quantity"), (F.col("quantity") - F.when(F.col("id") % 103 == 0, 1).otherwise(0)).alias("filled_quantity"), F.when(F.col("id") % 107 == 0, "accepted").otherwise("filled").alias("status"))
    paid = fills.select(F.col("fill_id").alias("cost_id"), "fill_id", (F.col("fee_units") - F.when(F.col("fill_id") % 109 == 0, 3).otherwise(0)).alias("amount_units"))
    return {"orders": wanted, "fills": fills, "costs": paid}


_R = _ORDERS


@register("check_fill_integrity", f"""SELECT 'fill_notional' AS "check", CAST(id AS VARCHAR) AS key, CAST(quantity * open_units AS VARCHAR) AS expected, CAST(quantity * open_units + 1 AS VARCHAR) AS stated FROM ({_R}) WHERE id % 101 = 0""")
def check_fill_integrity(spark: SparkSession, d: str) -> DataFrame:
    t = result_tables(spark, d)
    return checks.fill_integrity(t["orders"], t["fills"])


@register("check_order_closure", f"""SELECT 'order_filled' AS "check", CAST(id AS VARCHAR) AS key, CAST(quantity AS VARCHAR) AS expected, CAST(quantity - 1 AS VARCHAR) AS stated FROM ({_R}) WHERE id % 103 = 0 UNION ALL SELECT 'order_status', CAST(id AS VARCHAR), 'filled', 'accepted' FROM ({_R}) WHERE id % 107 = 0""")
def check_order_closure(spark: SparkSession, d: str) -> DataFrame:
    t = result_tables(spark, d)
    return checks.order_closure(t["orders"], t["fills"])


@register("check_fee_closure", f"""SELECT 'fill_fee' AS "check", CAST(id AS VARCHAR) AS key, CAST(497 + id % 50 AS VARCHAR) AS expected, CAST(500 + id % 50 AS VARCHAR) AS stated FROM ({_R}) WHERE id % 109 = 0""")
def check_fee_closure(spark: SparkSession, d: str) -> DataFrame:
    t = result_tables(spark, d)
    return checks.fee_closure(t["fills"], t["costs"])


_CASH = "SELECT o_custkey AS portfolio_id, o_orderkey AS snapshot_id, o_orderdate AS valuation_time, 1000000 AS opening_cash_units, CAST(ROUND(o_totalprice) AS BIGINT) * (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE -1 END) AS change FROM orders"


def cash_table(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("portfolio_id").orderBy("valuation_time", "snapshot_id").rowsBetween(Window.unboundedPreceding, 0)
    change = F.round("o_totalprice").cast("bigint") * F.when(F.col("o_orderstatus") == "F", 1).otherwise(-1)
    rows = scan(spark, d, "orders").select(F.col("o_custkey").alias("portfolio_id"), F.col("o_orderkey").alias("snapshot_id"), F.col("o_orderdate").alias("valuation_time"), F.lit(1_000_000).cast("bigint").alias("opening_cash_units"), change.alias("trade_cash_change_units"), F.lit(0).cast("bigint").alias("non_trade_cash_change_units"))
    return rows.withColumn("total_cash_units", F.lit(1_000_000) + F.sum("trade_cash_change_units").over(w) + F.when(F.col("snapshot_id") % 113 == 0, 5).otherwise(0))


@register("check_cash_running", f"""SELECT 'cash_running' AS "check", CAST(snapshot_id AS VARCHAR) AS key, CAST(total AS VARCHAR) AS expected, CAST(total + 5 AS VARCHAR) AS stated FROM (SELECT *, opening_cash_units + CAST(SUM(change) OVER (PARTITION BY portfolio_id ORDER BY valuation_time, snapshot_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM ({_CASH})) WHERE snapshot_id % 113 = 0""")
def check_cash_running(spark: SparkSession, d: str) -> DataFrame:
    return checks.cash_conservation(cash_table(spark, d))


def position_table(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("portfolio_id", "instrument_id").orderBy("valuation_time", "snapshot_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = orders(spark, d).select(F.col("account").alias("portfolio_id"), (F.col("code") % 20).alias("instrument_id"), F.col("day").alias("valuation_time"), F.col("id").alias("snapshot_id"), F.col("quantity").alias("trade_quantity_change"), F.lit(0).cast("bigint").alias("non_trade_quantity_change"), F.col("open_units").alias("price"))
    held_ = F.sum("trade_quantity_change").over(w) + F.when(F.col("snapshot_id") % 211 == 0, 1).otherwise(0)
    rows = rows.withColumn("quantity", held_)
    return rows.withColumns({"sellable_quantity": F.col("quantity") - F.when(F.col("snapshot_id") % 223 == 0, 2).otherwise(0), "unsettled_quantity": F.lit(0).cast("bigint"), "frozen_quantity": F.lit(0).cast("bigint"), "market_value_units": F.col("quantity") * F.col("price")})


@register(
    "check_position_running",
    f"""WITH p AS (SELECT id, CAST(SUM(quantity) OVER (PARTITION BY account, code % 20 ORDER BY day, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS q FROM ({_ORDERS}))
SELECT 'position_running' AS "check", CAST(id AS VARCHAR) AS key, CAST(q AS VARCHAR) AS expected, CAST(q + 1 AS VARCHAR) AS stated FROM p WHERE id % 211 = 0 UNION ALL SELECT 'position_buckets', CAST(id AS VARCHAR), CAST(q + CASE WHEN id % 211 = 0 THEN 1 ELSE 0 END - 2 AS VARCHAR), CAST(q + CASE WHEN id % 211 = 0 THEN 1 ELSE 0 END AS VARCHAR) FROM p WHERE id % 223 = 0""",
)
def check_position_running(spark: SparkSession, d: str) -> DataFrame:
    return checks.position_conservation(position_table(spark, d))


@register(
    "check_valuation",
    f"""WITH c AS (SELECT o_custkey AS p, CAST(SUM(CAST(ROUND(o_totalprice) AS BIGINT)) AS BIGINT) AS cash FROM orders GROUP BY 1), h AS (SELECT account AS p, CAST(SUM(quantity * open_units) AS BIGINT) AS held FROM ({_ORDERS}) GROUP BY 1)
SELECT 'valuation' AS "check", CAST(c.p AS VARCHAR) || '@1' AS key, CAST(cash + COALESCE(held, 0) AS VARCHAR) AS expected, CASE WHEN c.p % 17 = 0 THEN CAST(cash + COALESCE(held, 0) + 9 AS VARCHAR) END AS stated FROM c LEFT JOIN h USING (p) WHERE c.p % 17 = 0 OR c.p % 19 = 0""",
)
def check_valuation(spark: SparkSession, d: str) -> DataFrame:
    cash = scan(spark, d, "orders").groupBy(F.col("o_custkey").alias("portfolio_id")).agg(F.sum(F.round("o_totalprice").cast("bigint")).alias("total_cash_units")).withColumn("valuation_time", F.lit(1))
    held_ = orders(spark, d).select(F.col("account").alias("portfolio_id"), F.lit(1).alias("valuation_time"), (F.col("quantity") * F.col("open_units")).alias("market_value_units"))
    worth = held_.groupBy("portfolio_id").agg(F.sum("market_value_units").alias("h"))
    stated = cash.join(worth, "portfolio_id", "left").where("portfolio_id % 19 <> 0 or portfolio_id % 17 = 0").select("portfolio_id", "valuation_time", (F.col("total_cash_units") + F.coalesce("h", F.lit(0)) + F.when(F.col("portfolio_id") % 17 == 0, 9).otherwise(0)).alias("nav_units"))
    return checks.valuation_closure(cash, held_, stated)


@register("check_fill_positions", f"SELECT account AS portfolio_id, code AS instrument_id, day AS session, CAST(q AS BIGINT) AS quantity_change, CAST(SUM(q) OVER (PARTITION BY account, code ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS holding FROM (SELECT account, code, day, SUM(CASE WHEN side = 'buy' THEN quantity ELSE -quantity END) AS q FROM ({_R}) GROUP BY 1, 2, 3)")
def check_fill_positions(spark: SparkSession, d: str) -> DataFrame:
    return checks.daily_fill_positions(result_tables(spark, d)["fills"])


@register("check_fills_without_snapshot", f"SELECT DISTINCT account AS portfolio_id, code AS instrument_id, day AS session FROM ({_R}) EXCEPT SELECT account, code, day FROM ({_R}) WHERE id % 3 = 0")
def check_fills_without_snapshot(spark: SparkSession, d: str) -> DataFrame:
    fills = result_tables(spark, d)["fills"]
    return checks.fills_without_snapshot(fills, fills.where("fill_id % 3 = 0"))


# Ledgers: ordered folds ------------------------------------------------------------------------

#: What happens to an account for each order, in steps: kind, and the changes of free, held and owed cash and of shares.
_SPOT_STEPS = """SELECT account, id * 10 + step AS seq, code, da, df, dw, dq FROM (SELECT *, quantity * open_units + 500 AS cost, quantity // 2 AS sold FROM ({orders})) CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6)) s(step),
 LATERAL (SELECT CASE step WHEN 0 THEN -cost WHEN 4 THEN sold * open_units - 300 WHEN 6 THEN 60 ELSE 0 END AS da, CASE step WHEN 0 THEN cost WHEN 1 THEN -cost ELSE 0 END AS df, CASE step WHEN 5 THEN 60 WHEN 6 THEN -60 ELSE 0 END AS dw, CASE step WHEN 1 THEN quantity WHEN 4 THEN -sold WHEN 5 THEN 10 ELSE 0 END AS dq)
 WHERE step < 3 OR (step < 5 AND side = 'sell') OR (step >= 5 AND id % 4 = 0)"""


def account_events(spark: SparkSession, d: str) -> DataFrame:
    """Each order as a purchase (reserved, filled, settled), for sellers the sale of half of it, and for every fourth an action with what it owes."""
    rows = orders(spark, d).select("account", "id", F.col("code").cast("string").alias("code"), "quantity", "open_units", F.col("day").cast("date").cast("string").alias("day"), (F.col("side") == "sell").alias("sells"))
    sold, notional = F.floor(F.col("quantity") / 2), F.col("quantity") * F.col("open_units")
    none, text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    claim = lambda name: F.concat_ws(":", F.lit(name), F.col("id").cast("string"))

    def event(step: int, kind: str, side=text, quantity=none, notional_units=none, fee=none, cash=none, receivable=none, receivable_id=text, entitlement=none, entitlement_id=text, code=None):
        fields = {"step": F.lit(step), "kind": F.lit(kind), "side": side, "quantity": quantity, "notional_units": notional_units, "fee_units": fee, "cash_units": cash, "cash_receivable_units": receivable, "receivable_id": receivable_id, "entitlement_quantity": entitlement, "entitlement_id": entitlement_id, "code": F.col("code") if code is None else code}
        return F.struct(*[v.alias(k) for k, v in fields.items()])

    units = lambda n: F.lit(n).cast("bigint")
    bought = [event(0, "cash_reserved", cash=notional + 500), event(1, "fill", F.lit("buy"), F.col("quantity"), notional, units(500)), event(2, "settlement", quantity=F.col("quantity"))]
    gone = [event(3, "position_reserved", quantity=sold), event(4, "fill", F.lit("sell"), sold, sold * F.col("open_units"), units(300))]
    action = [event(5, "corporate_action", receivable=units(60), receivable_id=claim("r"), entitlement=units(10), entitlement_id=claim("e")), event(6, "settlement", receivable_id=claim("r"), entitlement_id=claim("e"), code=text)]
    empty = F.array_remove(F.array(bought[0]), bought[0])
    steps = F.concat(F.array(*bought), F.when(F.col("sells"), F.array(*gone)).otherwise(empty), F.when(F.col("id") % 4 == 0, F.array(*action)).otherwise(empty))
    each = rows.select("account", "id", "day", F.explode(steps).alias("e")).select("account", "id", "day", "e.*")
    return each.select("account", (F.col("id") * 10 + F.col("step")).alias("seq"), F.concat_ws(":", F.col("id").cast("string"), F.col("step").cast("string")).alias("event_id"), "day", F.col("day").alias("due_date"), *[c for c in each.columns if c not in ("account", "id", "day", "step")])


_SPOT_SQL = _SPOT_STEPS.format(orders=_ORDERS)


@register(
    "ledger_spot_fold",
    f"""WITH e AS ({_SPOT_SQL}), r AS (SELECT *, 10000000000000 + SUM(da) OVER w AS a, SUM(df) OVER w AS f, SUM(dw) OVER w AS o, SUM(dq) OVER w AS q, SUM(dq) OVER (PARTITION BY account, code ORDER BY seq) AS h FROM e WINDOW w AS (PARTITION BY account ORDER BY seq))
SELECT account, COUNT(*) AS events, CAST(arg_max(a, seq) AS BIGINT) AS available_units, CAST(MIN(a) AS BIGINT) AS least_units, CAST(SUM(f) AS BIGINT) AS frozen_sum, CAST(SUM(o) AS BIGINT) AS owed_sum, CAST(arg_max(q, seq) AS BIGINT) AS shares, CAST(SUM(q) AS BIGINT) AS shares_sum, CAST(SUM(CASE WHEN seq % 10 < 6 THEN h END) AS BIGINT) AS held_sum FROM r GROUP BY 1""",
)
def ledger_spot_fold(spark: SparkSession, d: str) -> DataFrame:
    rows = ledger.spot_ledger(account_events(spark, d), 10_000_000_000_000)
    return rows.groupBy("account").agg(
        F.count(F.lit(1)).alias("events"), F.max_by("available_units", "seq").alias("available_units"), F.min("available_units").alias("least_units"), F.sum("frozen_units").alias("frozen_sum"), F.sum("owed_units").alias("owed_sum"),
        F.max_by("shares", "seq").alias("shares"), F.sum("shares").alias("shares_sum"), F.sum(F.when(F.col("seq") % 10 < 6, F.col("held"))).alias("held_sum"),
    )


@register("ledger_cash_simulation")
def ledger_cash_simulation(spark: SparkSession, d: str) -> DataFrame:
    rows = orders(spark, d).select("account", F.col("id").alias("seq"), F.col("id").cast("string").alias("order_id"), F.col("day").cast("string").alias("day"), F.col("code").cast("string").alias("code"), "side", "quantity", "paused", "open_units", (F.col("high_limit_units") + 50).alias("high_limit_units"), (F.col("low_limit_units") - 50).alias("low_limit_units"), (F.col("sellable") * 3).alias("capacity"))
    return ledger.simulate_cash(rows, POLICY, 200_000_000)


#: A month's fill near its settlement price, the month's mark, and a margin call in every fifth month.
_FUTURES_SQL = f"""WITH m AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY account ORDER BY month) AS k, settlement_units + (month(month) % 7 - 3) * 100 AS price FROM ({_HELD})),
h AS (SELECT *, SUM(contracts) OVER w AS held, COALESCE(LAG(settlement_units) OVER w, 0) AS before FROM m WINDOW w AS (PARTITION BY account ORDER BY month)),
g AS (SELECT *, ((held - contracts) * (settlement_units - before) + contracts * (settlement_units - price)) * 5 - ABS(contracts) * 7 AS gain, (ABS(held) * settlement_units * 5 * 120000 + 999999) // 1000000 AS margin FROM h)"""


def futures_events(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("account").orderBy("month")
    rows = held(spark, d).withColumn("k", F.row_number().over(w).cast("bigint")).withColumn("total", F.sum("contracts").over(w)).withColumn("price", F.col("settlement_units") + (F.month("month") % 7 - 3) * 100)
    margin = trading.margin_units(F.col("total"), F.col("settlement_units"), F.lit(5).cast("bigint"), F.lit(120_000).cast("bigint"))
    none = F.lit(None).cast("bigint")
    event = lambda step, kind, contracts=none, price=none, fee=none, margin_=none: F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), contracts.alias("contracts"), price.alias("price_units"), fee.alias("fee_units"), margin_.alias("margin_units"))
    fill, mark = event(0, "fill", F.col("contracts"), F.col("price"), F.abs("contracts") * 7), event(1, "mark_to_market", price=F.col("settlement_units"), margin_=margin)
    call = event(2, "margin_call", margin_=margin * 2)
    each = rows.select("account", "k", F.explode(F.concat(F.array(fill, mark), F.when(F.col("k") % 5 == 0, F.array(call)).otherwise(F.array_remove(F.array(call), call)))).alias("e")).select("account", "k", "e.*")
    return each.select("account", (F.col("k") * 10 + F.col("step")).alias("seq"), F.concat_ws(":", F.col("k").cast("string"), F.col("step").cast("string")).alias("event_id"), F.lit("c").alias("code"), F.lit(5).cast("bigint").alias("multiplier"), "kind", "contracts", "price_units", "fee_units", "margin_units")


@register("ledger_futures_fold", f"{_FUTURES_SQL} SELECT account, k AS month_number, CAST(100000000000000 + SUM(gain) OVER (PARTITION BY account ORDER BY month) AS BIGINT) AS equity_units, CAST(SUM(gain) OVER (PARTITION BY account ORDER BY month) AS BIGINT) AS realised_units, CAST(margin * CASE WHEN k % 5 = 0 THEN 2 ELSE 1 END AS BIGINT) AS margin_units, CAST(ABS(held) AS BIGINT) AS contracts FROM g")
def ledger_futures_fold(spark: SparkSession, d: str) -> DataFrame:
    """The account after every month: fills above and below the settlement, reversals, marks and margin calls."""
    out = ledger.futures_ledger(futures_events(spark, d), 100_000_000_000_000)
    last = lambda c: F.max_by(c, "seq").alias(c)
    return out.groupBy("account", F.expr("seq div 10").alias("month_number")).agg(last("equity_units"), last("realised_units"), last("margin_units"), last("contracts"))


# Simulations -----------------------------------------------------------------------------------


def minute_market(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, simulation.MinutePolicy]:
    """Users' 120-minute bars, ten users an account, and a target at every third decision bar."""
    from tidemark.plans.minute import resampled

    rows = resampled(spark, d, 120).select(
        F.floor(F.col("code").cast("bigint") / 10).alias("account"), "code", F.col("trading_date").cast("string").alias("session"), "bar_start", "dt", F.col("dt").alias("available_time"), F.lit(0).cast("bigint").alias("seq"),
        F.round(F.col("open") * 100).cast("bigint").alias("open_units"), F.round(F.col("close") * 100).cast("bigint").alias("close_units"), (F.col("volume") * 1000).cast("bigint").alias("volume"), F.lit(True).alias("completed"), F.lit("pass").alias("quality_status"),
        F.lit(10_000_000).cast("bigint").alias("high_limit_units"), F.lit(0).cast("bigint").alias("low_limit_units"),
    )
    w = Window.partitionBy("code").orderBy("dt")
    asked = rows.withColumn("k", F.row_number().over(w)).withColumn("left", F.lead("bar_start").over(w)).where("k % 3 = 1 and left >= dt").select("account", "code", F.col("dt").alias("decision_time"), ((F.col("k") % 5 + 1) * 100).cast("bigint").alias("target_quantity"))
    last = rows.groupBy("account").agg(F.max("bar_start").alias("end"))
    asked = asked.join(last, "account").where("decision_time <= end").drop("end")
    return rows, asked, simulation.MinutePolicy()


@register("simulate_minute_targets")
def simulate_minute_targets(spark: SparkSession, d: str) -> DataFrame:
    rows, asked, policy = minute_market(spark, d)
    return simulation.simulate_minutes(rows, asked, policy, 100_000_000)


@register(
    "simulate_futures_daily",
    f"""WITH m AS (SELECT *, COALESCE(LAG(contracts) OVER w, 0) AS p, COALESCE(LAG(settlement_units) OVER w, 0) AS before, settlement_units + (month(month) % 7 - 3) * 100 AS price FROM ({_HELD}) WINDOW w AS (PARTITION BY account ORDER BY month)),
x AS (SELECT *, CASE WHEN p * contracts < 0 THEN ABS(p) ELSE GREATEST(ABS(p) - ABS(contracts), 0) END AS shut, CASE WHEN p * contracts < 0 THEN ABS(contracts) ELSE GREATEST(ABS(contracts) - ABS(p), 0) END AS opened, SIGN(p) AS sp, SIGN(contracts) AS sc FROM m),
y AS (SELECT *, sp * shut * (price - before) AS pnl_fill, (p - sp * shut) * (settlement_units - before) + sc * opened * (settlement_units - price) AS pnl_mark, shut + 3 * opened AS fee FROM x)
SELECT account, CAST(month AS DATE) AS session, CAST(shut + opened AS BIGINT) AS traded, CAST(fee AS BIGINT) AS fee_units, CAST(pnl_fill + pnl_mark AS BIGINT) AS pnl_units, CAST(1000000000000 + SUM(pnl_fill + pnl_mark - fee) OVER (PARTITION BY account ORDER BY month) AS BIGINT) AS equity_units, contracts AS position FROM y WHERE shut + opened > 0 OR contracts <> 0""",
    dates=("session",),
)
def simulate_futures_daily(spark: SparkSession, d: str) -> DataFrame:
    """Monthly targets of suppliers, traded near the settlement price; by session, with the account after it."""
    w = Window.partitionBy("account").orderBy("month")
    rows = held(spark, d).withColumn("price", F.col("settlement_units") + (F.month("month") % 7 - 3) * 100)
    product, session = F.col("account").cast("string").alias("product"), F.col("month").cast("date").alias("session")
    marks = rows.select(product, session, F.lit("c").alias("contract"), "settlement_units")
    moves = rows.select("account", "month", "price", F.lag(F.lit("c")).over(w).alias("old_contract"), F.lit("c").alias("new_contract"), F.lit(False).alias("roll"), F.coalesce(F.lag("contracts").over(w), F.lit(0)).alias("held"), F.col("contracts").alias("target"))
    legs = trading.decompose_roll(moves).select(product, session, "leg", "contract", "side", "contracts", F.when(F.col("offset") == "close_today", "close_yesterday").otherwise(F.col("offset")).alias("offset"), F.col("price").alias("open_units"), F.lit(False).alias("blocked"))
    rules = simulation.FuturesRules(1, 100, (("open", 3), ("close_today", 2), ("close_yesterday", 1)))
    out = simulation.simulate_futures(legs, marks, rules, 1_000_000_000_000)
    last = lambda c: F.max_by(c, "seq").alias(c)
    return out.groupBy(F.col("product").cast("bigint").alias("account"), F.col("session").cast("string").alias("session")).agg(F.sum(F.when(F.col("kind") == "fill", F.col("quantity")).otherwise(0)).alias("traded"), F.sum("fee_units").alias("fee_units"), F.sum("pnl_units").alias("pnl_units"), last("equity_units"), last("position"))


_FILLS = "SELECT id, account, day, quantity, quantity * open_units AS n, GREATEST(500, (quantity * open_units * 300 + 999999) // 1000000) + (quantity * open_units * 10 + 999999) // 1000000 AS fee FROM ({})"


def _simulated(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The result tables of purchases that all fill, with faults put into costs, cash and positions."""
    rows = orders(spark, d).select("account", F.col("id").alias("seq"), F.col("day").cast("date").alias("day"), "code", "quantity", "open_units")
    derived = {
        "order_id": F.col("seq").cast("string"), "day": F.col("day").cast("string"), "code": F.col("code").cast("string"), "side": F.lit("buy"), "paused": F.lit(False),
        "high_limit_units": F.col("open_units") + 1, "low_limit_units": F.lit(0).cast("bigint"), "capacity": F.col("quantity"),
    }
    policy = trading.CashPolicy(lot=20, slippage_units=0)
    tables = simulation.project_cash(kept(ledger.simulate_cash(rows, policy, 10_000_000_000_000, ["day", "seq"], True, derived), "account"), 10_000_000_000_000)
    costs, cash, positions = tables["costs"], tables["cash"], tables["positions"]
    return tables | {
        "costs": costs.withColumn("amount_units", F.col("amount_units") + F.when(F.split("cost_id", ":")[0].cast("bigint") % 97 == 0, 1).otherwise(0)),
        "cash": cash.withColumn("total_cash_units", F.col("total_cash_units") - F.when(F.col("portfolio_id") % 31 == 0, 3).otherwise(0)),
        "positions": positions.withColumn("frozen_quantity", F.when((F.col("portfolio_id") + F.col("instrument_id").cast("bigint")) % 503 == 0, 4).otherwise(0).cast("bigint")),
    }


@register(
    "result_findings",
    f"""WITH f AS ({_FILLS.format(_ORDERS)}), c AS (SELECT account, CAST(CAST(day AS DATE) AS VARCHAR) AS day, SUM(n + fee) AS spent FROM f GROUP BY 1, 2), r AS (SELECT *, CAST(10000000000000 - SUM(spent) OVER (PARTITION BY account ORDER BY day) AS BIGINT) AS total FROM c),
q AS (SELECT account, code, CAST(CAST(day AS DATE) AS VARCHAR) AS day, SUM(quantity) AS q FROM ({_ORDERS}) GROUP BY 1, 2, 3), h AS (SELECT *, CAST(SUM(q) OVER (PARTITION BY account, code ORDER BY day) AS BIGINT) AS held FROM q)
SELECT 'fill_fee' AS "check", id || ':f' AS key, CAST(fee + 1 AS VARCHAR) AS expected, CAST(fee AS VARCHAR) AS stated FROM f WHERE id % 97 = 0 UNION ALL SELECT 'cash_running', account || '@' || day, CAST(total AS VARCHAR), CAST(total - 3 AS VARCHAR) FROM r WHERE account % 31 = 0
UNION ALL SELECT 'position_buckets', account || '@' || code || '@' || day, CAST(held + 4 AS VARCHAR), CAST(held AS VARCHAR) FROM h WHERE (account + code) % 503 = 0""",
)
def result_findings(spark: SparkSession, d: str) -> DataFrame:
    """What is found against simulated results into which faults were put: those, and nothing else."""
    return simulation.verify_result(_simulated(spark, d))


@register("result_gates", f"WITH f AS ({_ORDERS}), c AS (SELECT concat_ws(',', CASE WHEN (SELECT COUNT(*) FROM f WHERE account % 31 = 0) > 0 THEN 'cash_running' END, CASE WHEN (SELECT COUNT(*) FROM f WHERE id % 97 = 0) > 0 THEN 'fill_fee' END, CASE WHEN (SELECT COUNT(*) FROM f WHERE (account + code) % 503 = 0) > 0 THEN 'position_buckets' END) AS codes) SELECT gate, CASE WHEN gate = 'statistics' THEN 'not_applicable' WHEN gate = 'financial.tradability' AND codes <> '' THEN 'fail' ELSE 'pass' END AS status, CASE WHEN gate = 'financial.tradability' THEN codes ELSE '' END AS reason_codes FROM (VALUES ('data.pit'), ('label.split'), ('search.holdout'), ('statistics'), ('financial.tradability')) g(gate), c")
def result_gates(spark: SparkSession, d: str) -> DataFrame:
    return simulation.gates(result_findings(spark, d), not_applicable=("statistics",))


@register(
    "futures_audit",
    """WITH m AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS VARCHAR) AS code, COUNT(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT issue, dataset, CAST(COUNT(*) AS BIGINT) AS findings FROM (SELECT 'duplicate_primary_key' AS issue, 'market' AS dataset FROM m WHERE n > 1 UNION ALL SELECT 'settlement_missing', 'settlement' FROM m, range(CAST(n AS BIGINT)) r WHERE CAST(code AS INT) % 4 = 0) GROUP BY 1, 2""",
)
def futures_audit(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    market = scan(spark, d, "lineitem").select(day.alias("date"), F.col("l_suppkey").cast("string").alias("code"), *[F.col("l_extendedprice").alias(c) for c in ("open", "high", "low", "close")], F.col("l_quantity").alias("volume"), F.col("l_quantity").alias("open_interest"))
    lifecycle = scan(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("code"), F.lit("1980-01-01").cast("date").alias("listed"), F.lit("2040-01-01").cast("date").alias("delisted"))
    settled = market.where("code % 4 <> 0").select("date", "code", F.col("close").alias("settle_price")).dropDuplicates(["date", "code"])
    out = simulation.audit_futures(market, lifecycle, None, F.lit("1990-01-01").cast("date"), F.lit("2029-12-31").cast("date"), settled)
    return out.groupBy("issue", "dataset").agg(F.count(F.lit(1)).alias("findings"))


@register("execution_price_audit", "SELECT verdict, COUNT(*) AS samples FROM (SELECT CASE WHEN p_partkey % 3 = 0 AND p_size > 40 THEN 'fail' WHEN p_partkey % 3 = 0 THEN 'verified' WHEN p_partkey % 3 = 1 AND p_size <= 40 THEN 'vendor_confirmed' WHEN p_partkey % 3 = 1 THEN 'warn' ELSE 'unverified' END AS verdict FROM part) GROUP BY 1")
def execution_price_audit(spark: SparkSession, d: str) -> DataFrame:
    p, price = F.col("p_partkey") % 3, F.col("p_retailprice")
    other = F.when(F.col("p_size") > 40, price * 1.1).otherwise(price)
    rows = scan(spark, d, "part").select(price.alias("local_price"), F.when(p == 0, other).alias("official_price"), F.when(p == 1, other).alias("vendor_price"))
    return simulation.audit_execution_prices(rows, 5).groupBy("verdict").agg(F.count(F.lit(1)).alias("samples"))
