"""Simulations by hand: minute targets, daily futures, result tables, gates and audits."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ledger, simulation, trading

START = datetime(2024, 1, 2, 9, 30)


def fails(df):
    with pytest.raises(Exception) as e:
        df.collect()
    return str(e.value)


BAR = "account bigint, code string, session string, bar_start timestamp_ntz, dt timestamp_ntz, available_time timestamp_ntz, seq bigint, open_units bigint, close_units bigint, volume bigint, completed boolean, quality_status string, high_limit_units bigint, low_limit_units bigint"


def bars(spark, prices, code="x", per_day=3, volume=10_000, **bad):
    rows = []
    for k, price in enumerate(prices):
        at = START + timedelta(days=k // per_day, minutes=k % per_day)
        end = at + timedelta(minutes=1)
        rows.append((1, code, f"d{k // per_day}", at, end, end, k, price, price + 1, volume, k not in bad.get("open", ()), "pass", 10_000, 1))
    return spark.createDataFrame(rows, BAR)


def targets(spark, *rows):
    return spark.createDataFrame([(1, "x", START + timedelta(days=d, minutes=m), q) for d, m, q in rows], "account bigint, code string, decision_time timestamp_ntz, target_quantity bigint")


POLICY = simulation.MinutePolicy(trading.CashPolicy(minimum_commission=0, commission_ppm=0, transfer_ppm=0, sell_tax_ppm=0))


def run(spark, b, t, opening=1_000_000):
    return simulation.simulate_minutes(b, t, POLICY, opening).orderBy("seq").collect()


def test_targets_trade_in_the_bars_after_their_decision(spark):
    out = run(spark, bars(spark, [100, 101, 102, 103, 104, 105]), targets(spark, (0, 1, 1500)))
    fills = [(r.at, r.quantity, r.price_units) for r in out if r.kind == "fill"]
    assert fills == [(START + timedelta(minutes=2), 1000, 102), (START + timedelta(minutes=3), 500, 103)]
    assert [r.session for r in out if r.kind == "close"] == ["d0", "d1"]
    cash = 1_000_000 - 1000 * 102 - 500 * 103
    assert out[-1].cash_units == cash and out[-1].nav_units == cash + 1500 * 106


def test_what_was_bought_today_is_sold_tomorrow(spark):
    out = run(spark, bars(spark, [100] * 6), targets(spark, (0, 0, 500), (0, 1, 0)))
    assert [(r.kind, r.reason, r.session) for r in out if r.kind != "close"] == [("fill", None, "d0"), ("reject", "t1_sell_blocked", "d0"), ("reject", "t1_sell_blocked", "d0"), ("fill", None, "d1")]
    assert out[-1].position == 0


def test_incomplete_bars_do_not_trade_and_later_bars_change_nothing(spark):
    whole = run(spark, bars(spark, [100, 101, 102, 103], open=(1,)), targets(spark, (0, 0, 2000)))
    assert [r.price_units for r in whole if r.kind == "fill"] == [101, 103]
    part = run(spark, bars(spark, [100, 101, 102], open=(1,)), targets(spark, (0, 0, 2000)))
    assert [tuple(r) for r in part] == [tuple(r) for r in whole[: len(part)]]
    twice = bars(spark, [100, 101])
    assert "comes twice" in fails(simulation.simulate_minutes(twice.unionAll(twice), targets(spark, (0, 0, 100)), POLICY, 1000))
    assert "no later bar" in fails(simulation.simulate_minutes(twice, targets(spark, (5, 0, 100)), POLICY, 1000))


def test_decision_bars(spark):
    b = bars(spark, [100, 101, 102])
    out = simulation.next_eligible(targets(spark, (0, 1, 100)), b, ["account", "code"]).collect()[0]
    assert out.decision_bar_end == START + timedelta(minutes=1) and out.decision_units == 101
    assert "no decision bar" in fails(simulation.next_eligible(targets(spark, (0, 0, 100)), b, ["account", "code"]))
    assert "no decision bar" in fails(simulation.next_eligible(targets(spark, (0, 3, 100)), b, ["account", "code"]))


LEG = "product string, session date, leg int, contract string, side string, contracts bigint, offset string, open_units bigint, blocked boolean"
RULES = simulation.FuturesRules(10, 100_000, (("open", 3), ("close_today", 2), ("close_yesterday", 1)))


def day(n):
    return date(2024, 1, n)


def test_futures_by_hand(spark):
    legs = spark.createDataFrame([("p", day(2), 0, "a", "buy", 2, "open", 100, False), ("p", day(3), 0, "a", "sell", 2, "close_yesterday", 104, False), ("p", day(3), 1, "b", "buy", 1, "open", 200, False)], LEG)
    marks = spark.createDataFrame([("p", day(2), "a", 103), ("p", day(3), "a", 105), ("p", day(3), "b", 199), ("p", day(4), "b", 190)], "product string, session date, contract string, settlement_units bigint")
    out = simulation.simulate_futures(legs, marks, RULES, 1000).orderBy("seq").collect()
    assert [(r.kind, r.pnl_units, r.fee_units, r.equity_units, r.position) for r in out] == [("fill", 0, 6, 994, 2), ("settle", 60, 0, 1054, 2), ("fill", 20, 2, 1072, 0), ("fill", 0, 3, 1069, 1), ("settle", -10, 0, 1059, 1), ("settle", -90, 0, 969, 1)]
    assert out[1].margin_units == 206
    simulated = simulation.simulate_futures(legs, marks, RULES, 1000)
    kinds = spark.createDataFrame([("p", "grain")], "product string, category string")
    parts = simulation.futures_contributions(simulated, kinds, 1000)
    total = simulation.combine_products(parts, 1000).orderBy("session").collect()
    assert [r.equity_units for r in total] == [1054, 1059, 969]
    assert [(r.pnl_units, r.fee_units, r.margin_units) for r in parts.orderBy("session").collect()] == [(54, 6, 206), (5, 5, 199), (-90, 0, 190)]
    two = parts.unionByName(parts.withColumn("product", F.lit("q")))
    assert [r.equity_units for r in simulation.combine_products(two, 1000).orderBy("session").collect()] == [1108, 1118, 938]
    assert "cover" in fails(simulation.futures_contributions(simulated, kinds.unionAll(spark.createDataFrame([("z", "metal")], kinds.schema)), 1000))
    assert "passes the portfolio" in fails(simulation.combine_products(parts.withColumn("margin_units", F.lit(10_000)), 1000))
    tables = simulation.project_futures(simulated, 10, 1000)
    assert simulation.verify_result(tables).collect() == []
    assert [(r.trade_cash_change_units, r.non_trade_cash_change_units, r.total_cash_units) for r in tables["cash"].orderBy("valuation_time").collect()] == [(-6, 60, 1054), (15, -10, 1059), (0, -90, 969)]
    assert [(r.instrument_id, r.quantity, r.trade_quantity_change) for r in tables["positions"].orderBy("valuation_time", "instrument_id").collect()] == [("a", 2, 2), ("a", 0, -2), ("b", 1, 1), ("b", 1, 0)]


def test_intents_close_the_old_contract_first(spark):
    targets = spark.createDataFrame([("p", day(2), "a", 3), ("p", day(3), "a", 1), ("p", day(4), "b", -2), ("p", day(5), "b", 2), ("p", day(8), "b", 2)], "product string, session date, contract string, target_quantity bigint")
    days = spark.createDataFrame([(day(n),) for n in (2, 3, 4, 5, 8, 9)], "session date")
    out = simulation.futures_intents(targets, days).orderBy("session", "leg").collect()
    assert [(r.session.day, r.target_sequence, r.contract, r.side, r.contracts, r.offset) for r in out] == [(3, 0, "a", "buy", 3, "open"), (4, 1, "a", "sell", 2, "close_yesterday"), (5, 2, "a", "sell", 1, "close_yesterday"), (5, 2, "b", "sell", 2, "open"), (8, 3, "b", "buy", 2, "close_yesterday"), (8, 3, "b", "buy", 2, "open")]
    late = targets.where("session < '2024-01-08'").unionAll(spark.createDataFrame([("p", day(8), "b", 5)], targets.schema))
    assert "no later session" in fails(simulation.futures_intents(late, days.where("session < '2024-01-09'")))
    assert "two targets" in fails(simulation.futures_intents(targets.unionAll(targets), days))


def test_forced_liquidation_and_blocked_closing(spark):
    legs = spark.createDataFrame([("p", day(2), 0, "a", "buy", 4, "open", 100, False), ("q", day(2), 0, "a", "sell", 1, "open", 100, False), ("q", day(3), 0, "a", "buy", 1, "close_yesterday", 100, True), ("q", day(3), 1, "b", "buy", 1, "open", 100, False)], LEG)
    marks = spark.createDataFrame([("p", day(2), "a", 82), ("q", day(2), "a", 100), ("q", day(3), "a", 101)], "product string, session date, contract string, settlement_units bigint")
    out = simulation.simulate_futures(legs, marks, RULES, 1000).orderBy("product", "seq").collect()
    assert [r.kind for r in out if r.product == "p"] == ["fill", "settle", "forced"] and [r.position for r in out if r.product == "p"][-1] == 0
    assert [r.reason for r in out if r.product == "q" and r.kind == "reject"] == ["not_tradable", "closing_leg_blocked"]
    wrong = spark.createDataFrame([("p", day(2), 0, "a", "sell", 1, "close_today", 100, False)], LEG)
    assert "does not fit" in fails(simulation.simulate_futures(wrong, marks, RULES, 1000))


def test_simulated_results_pass_their_checks(spark):
    rows = [(a, k, f"{a}-{k}", f"2024-01-0{1 + k // 3}", "xy"[k % 2], "sell" if k % 4 == 3 else "buy", 100 * (k + 1), False, 100 + k, 10_000, 1, 100_000) for a in (1, 2) for k in range(9)]
    orders = spark.createDataFrame(rows, "account bigint, seq bigint, order_id string, day string, code string, side string, quantity bigint, paused boolean, open_units bigint, high_limit_units bigint, low_limit_units bigint, capacity bigint")
    done = ledger.simulate_cash(orders, trading.CashPolicy(), 500_000).join(orders.select("order_id", "day"), "order_id")
    tables = simulation.project_cash(done, 500_000)
    assert set(tables) == {"orders", "fills", "costs", "cash", "positions", "valuations"}
    assert simulation.verify_result(tables).collect() == []
    broken = tables | {"costs": tables["costs"].where("cost_id <> '1-0:c'"), "cash": tables["cash"].withColumn("total_cash_units", F.col("total_cash_units") + F.when(F.col("portfolio_id") == 2, 1).otherwise(0))}
    found = simulation.verify_result(broken)
    assert {r.check for r in found.collect()} == {"fill_fee", "cash_running"}
    status = {r.gate: (r.status, r.reason_codes) for r in simulation.gates(found, not_applicable=("statistics",)).collect()}
    assert status == {"data.pit": ("pass", ""), "label.split": ("pass", ""), "search.holdout": ("pass", ""), "statistics": ("not_applicable", ""), "financial.tradability": ("fail", "cash_running,fill_fee")}
    assert "no gate" in fails(simulation.gates(found.withColumn("check", F.lit("odd"))))


def test_audits(spark):
    market = spark.createDataFrame([(day(2), "a", 10.0, 11.0, 9.0, 10.5, 5.0, 1.0), (day(3), "a", 10.0, 9.0, 9.5, 10.5, 5.0, 1.0), (day(3), "a", 10.0, 11.0, 9.0, 10.5, -1.0, None), (day(4), "b", 1.0, 1.0, 1.0, 1.0, 0.0, 0.0), (day(4), "c", 1.0, 1.0, 1.0, 1.0, 0.0, 0.0)], "date date, code string, open double, high double, low double, close double, volume double, open_interest double")
    lifecycle = spark.createDataFrame([("a", day(1), day(2))], "code string, listed date, delisted date")
    settlement = spark.createDataFrame([(day(2), "a", 10.0), (day(3), "a", 0.0)], "date date, code string, settle_price double")
    out = {(r.issue, r.key) for r in simulation.audit_futures(market, lifecycle, ["a", "b"], day(1), day(9), settlement).collect()}
    assert out == {("duplicate_primary_key", "2024-01-03:a"), ("ohlc_invalid", "2024-01-03:a"), ("observation_market_invalid", "2024-01-03:a"), ("missing_ratio_exceeded", "open_interest"), ("lifecycle_missing", "b"), ("outside_lifecycle", "2024-01-03:a"), ("settlement_missing", "2024-01-04:b"), ("settlement_invalid", "2024-01-03:a")}
    empty = simulation.audit_futures(market, lifecycle, ["z"], day(1), day(9), trading=False).collect()
    assert {r.issue for r in empty} == {"market_empty"}
    prices = spark.createDataFrame([("k", 100.0, 100.0, 90.0), ("l", 100.0, 102.0, 100.0), ("m", 100.0, None, 100.0), ("n", 100.0, None, 90.0), ("o", 100.0, None, None)], "key string, local_price double, official_price double, vendor_price double")
    assert [r.verdict for r in simulation.audit_execution_prices(prices, 5).orderBy("key").collect()] == ["verified", "fail", "vendor_confirmed", "warn", "unverified"]
