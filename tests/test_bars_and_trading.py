"""Bars, ledgers and trading rules by hand."""

from datetime import date, datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bars, checks, ledger, trading
from tidemark.operators.ledger import Holding, Lot, Spot, reduce_futures, reduce_spot


def fails(df):
    with pytest.raises(Exception) as e:
        df.collect()
    return str(e.value)


BAR = "code string, dt timestamp_ntz, open double, high double, low double, close double, volume double, money double, avg double"
START = datetime(2024, 1, 2, 9, 30)


def minute(spark, minutes, code="a", price=lambda k: 10.0 + k, volume=lambda k: 1.0):
    return spark.createDataFrame([(code, START + timedelta(minutes=k), price(k), price(k) + 1, price(k) - 1, price(k), volume(k), volume(k) * price(k), price(k)) for k in minutes], BAR)


def one_session(spark, length=7):
    return spark.createDataFrame([(date(2024, 1, 2), "am", "am-1", START, START + timedelta(minutes=length))], "trading_date date, session_id string, segment_id string, start timestamp_ntz, end timestamp_ntz")


def resample(spark, rows, n=5, end=START + timedelta(days=1), as_of=START + timedelta(days=1), length=7):
    return bars.resample(rows, one_session(spark, length), n, START, end, as_of).orderBy("dt").collect()


def test_bars_hold_their_ends_and_do_not_cross_sessions(spark):
    a, b = resample(spark, minute(spark, range(1, 8)))
    assert (a.dt, a.open, a.close, a.high, a.low, a.volume, a.observed_minutes, a.bar_status) == (START + timedelta(minutes=5), 11, 15, 16, 10, 5, 5, "complete")
    assert (b.dt, b.expected_minutes, b.observed_minutes, b.bar_status) == (START + timedelta(minutes=7), 2, 2, "segment_tail_partial")
    assert a.avg == pytest.approx(13) and a.avg_status == "volume_weighted_source_avg" and a.completed and not b.completed


def test_bar_statuses(spark):
    assert [r.bar_status for r in resample(spark, minute(spark, [1, 2, 4, 5, 6]))] == ["missing_minutes", "missing_minutes"]
    seen = resample(spark, minute(spark, [1, 2, 3]), as_of=START + timedelta(minutes=3))
    assert (seen[0].visible_minutes, seen[0].bar_status) == (3, "query_boundary_partial")
    flat = resample(spark, minute(spark, range(1, 8), volume=lambda k: 0.0))
    assert flat[0].avg is None and flat[0].avg_status == "undefined_zero_volume"
    blank = resample(spark, minute(spark, range(1, 8)).withColumn("avg", F.when(F.col("close") != 12, F.col("avg"))))
    assert blank[0].avg_status == "unavailable_source_avg" and blank[0].avg is None


def test_unsound_minutes_are_errors(spark):
    good = minute(spark, range(1, 4))
    end = START + timedelta(days=1)
    run = lambda df: bars.resample(df, one_session(spark), 5, START, end, end)
    assert "breaks its bounds" in fails(run(good.withColumn("high", F.col("low") - 1)))
    assert "breaks its bounds" in fails(run(good.withColumn("volume", F.lit(-1.0))))
    assert "breaks its bounds" in fails(run(good.withColumn("close", F.lit(float("nan")))))
    assert "repeated" in fails(run(good.unionAll(good.limit(1))))
    assert "no session" in fails(run(minute(spark, [9])))


def test_features_start_again_at_a_gap(spark):
    rows = minute(spark, [1, 2, 3, 6, 7], price=lambda k: 10.0 * k).withColumns({"trading_date": F.lit(date(2024, 1, 2)), "session_id": F.lit("am")})
    out = bars.intraday_features(rows, 3, 2, 1).orderBy("dt").collect()
    assert [r.dt.minute - 30 for r in out] == [2, 3, 7]
    assert out[1].lagged_return == pytest.approx(0.5) and out[1].rolling_volatility == pytest.approx(0.25)
    assert out[0].volume_ratio == 1 and out[0].vwap_close_deviation == 0
    assert "gap" in fails(bars.intraday_features(rows, 3, 2, 1, gaps="fail"))


def test_features_do_not_change_when_later_bars_arrive(spark):
    marks = {"trading_date": F.lit(date(2024, 1, 2)), "session_id": F.lit("am")}
    run = lambda n: [tuple(r) for r in bars.intraday_features(minute(spark, range(1, n)).withColumns(marks), 3, 2, 1).orderBy("dt").collect()]
    assert run(7)[: len(run(5))] == run(5)


def test_labels(spark):
    rows = minute(spark, range(1, 7)).withColumns({"trading_date": F.lit(date(2024, 1, 2)), "session_id": F.lit("am")})
    close = bars.intraday_labels(rows, 2).orderBy("dt").collect()
    assert len(close) == 4 and close[0].future_return == pytest.approx(13 / 11 - 1) and close[0].available_time == START + timedelta(minutes=3)
    opened = bars.intraday_labels(rows, 2, "next_bar_open", overlap=False).orderBy("dt").collect()
    assert [r.dt.minute - 30 for r in opened] == [1, 3] and opened[0].future_return == pytest.approx(14 / 12 - 1)


def test_factors_use_only_announced_actions(spark):
    schema = "instrument string, effective_at timestamp_ntz, available timestamp_ntz, cash decimal(18,4), ratio double, previous_close decimal(18,2)"
    from decimal import Decimal

    rows = [("a", datetime(2024, 1, 5), datetime(2024, 1, 1), Decimal("1"), 1.0, Decimal("11.00")), ("a", datetime(2024, 1, 8), datetime(2024, 1, 9), Decimal("1"), 1.0, Decimal("10.00"))]
    out = bars.factor_segments(spark.createDataFrame(rows, schema), "1", datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 1, 20)).orderBy("segment_start").collect()
    assert [(r.segment_start.day, r.segment_end.day, round(r.factor, 6)) for r in out] == [(1, 5, 1.0), (5, 1, 1.1)]


def test_quality_names_what_is_wrong(spark):
    rows = minute(spark, [1, 2, 3, 9]).unionAll(minute(spark, [2])).withColumn("high", F.when(F.col("close") == 13, F.col("low") - 1).otherwise(F.col("high")))
    rows = rows.unionAll(minute(spark, [4]).withColumn("code", F.lit(None).cast("string")))
    issues = {(r.issue.rsplit(".", 1)[1], r.dt.minute - 30) for r in bars.quality_issues(rows, one_session(spark)).collect()}
    assert issues == {("duplicate_primary_key", 2), ("ohlc_invariant", 3), ("invalid_identity_or_time", 4), ("outside_expected_slot", 9), ("missing_expected_bar", 4), ("missing_expected_bar", 5), ("missing_expected_bar", 6), ("missing_expected_bar", 7)}
    back = minute(spark, [2, 1]).withColumn("n", F.when(F.minute("dt") == 32, 0).otherwise(1))
    assert [r.issue for r in bars.quality_issues(back, one_session(spark), expected=False, position="n").collect()] == ["minute.structural.sort_regression"]


# Ledgers ---------------------------------------------------------------------------------------


def test_spot_ledger_by_hand():
    s = Spot(10_000)
    for e in (
        {"event_id": "1", "kind": "cash_reserved", "cash_units": 5_500},
        {"event_id": "2", "kind": "fill", "side": "buy", "code": "x", "quantity": 100, "notional_units": 5_000, "fee_units": 500},
        {"event_id": "2", "kind": "fill", "side": "buy", "code": "x", "quantity": 100, "notional_units": 5_000, "fee_units": 500},
    ):
        reduce_spot(s, e)
    assert (s.available, s.frozen, s.lots["x"]) == (4_500, 0, Lot(0, 100, 0))
    with pytest.raises(ledger.LedgerError):
        reduce_spot(s, {"event_id": "3", "kind": "position_reserved", "code": "x", "quantity": 100})
    reduce_spot(s, {"event_id": "4", "kind": "settlement", "code": "x", "quantity": 100, "day": "2024-01-03"})
    reduce_spot(s, {"event_id": "5", "kind": "position_reserved", "code": "x", "quantity": 40})
    reduce_spot(s, {"event_id": "6", "kind": "fill", "side": "sell", "code": "x", "quantity": 40, "notional_units": 2_400, "fee_units": 100})
    assert s.available == 6_800 and s.lots["x"] == Lot(60, 0, 0)
    reduce_spot(s, {"event_id": "7", "kind": "corporate_action", "code": "x", "cash_receivable_units": 60, "receivable_id": "r", "entitlement_quantity": 6, "entitlement_id": "n", "due_date": "2024-02-01"})
    assert s.available == 6_800 and s.lots["x"] == Lot(60, 6, 0)
    with pytest.raises(ledger.LedgerError):
        reduce_spot(s, {"event_id": "8", "kind": "settlement", "receivable_id": "r", "day": "2024-01-31"})
    reduce_spot(s, {"event_id": "9", "kind": "settlement", "receivable_id": "r", "entitlement_id": "n", "day": "2024-02-01"})
    assert s.available == 6_860 and s.lots["x"] == Lot(66, 0, 0)


def test_a_failed_event_leaves_no_trace():
    s = Spot(100)
    reduce_spot(s, {"event_id": "1", "kind": "cash_reserved", "cash_units": 60})
    before = dict(s.balance)
    for e in ({"kind": "fill", "side": "buy", "code": "x", "quantity": 1, "notional_units": 100, "fee_units": 1}, {"kind": "corporate_action", "code": "x", "cash_delta_units": 5, "sellable_delta": -1}, {"kind": "cash_reserved", "cash_units": -1}):
        with pytest.raises(ledger.LedgerError):
            reduce_spot(s, {"event_id": "2", **e})
        assert s.balance == before and "2" not in s.seen


def test_futures_cost_is_exact():
    f = Holding()
    assert f.trade(1, 100, 10) == f.trade(2, 101, 10) == 0
    assert f.cost == Fraction(302, 3)
    assert f.trade(-3, 101, 10) == 10 and f.carried == 0 and f.cost is None
    f = Holding(3, Fraction(302, 3))
    assert [f.trade(-1, 101, 10) for _ in range(3)] == [3, 3, 4]
    f = Holding(2, 100)
    assert f.trade(-5, 90, 1) == -20 and (f.contracts, f.cost) == (-3, 90)
    assert f.mark(80, 1) == 30 and f.cost == 80
    s = ledger.Futures(1000)
    reduce_futures(s, {"event_id": "1", "kind": "fill", "code": "c", "contracts": 2, "price_units": 100, "multiplier": 5, "fee_units": 4})
    reduce_futures(s, {"event_id": "2", "kind": "mark_to_market", "code": "c", "price_units": 110, "multiplier": 5, "margin_units": 50})
    reduce_futures(s, {"event_id": "3", "kind": "fill", "code": "c", "contracts": -3, "price_units": 108, "multiplier": 5, "fee_units": 6})
    assert (s.equity, s.margin, s.holdings["c"].contracts, s.holdings["c"].cost) == (1000 - 4 + 100 - 20 - 6, 50, -1, 108)


def test_fees_and_affordable_lots():
    p = trading.CashPolicy()
    assert p.fee("buy", 10_000) == 501 and p.fee("sell", 10_000_000) == 3000 + 100 + 10_000
    for cash in range(0, 3_000_000, 7_919):
        want = max(q for q in range(0, 10_000, 100) if not q or q * 333 + p.fee("buy", q * 333) <= cash)
        assert p.affordable(cash, 9_999, 333) == min(want, 9_900)


def test_orders_of_an_account_depend_on_what_came_before(spark):
    rows = [
        (1, 1, "o1", "d1", "x", "buy", 1000, False, 100, 200, 50, 5000), (1, 2, "o2", "d1", "x", "sell", 500, False, 100, 200, 50, 5000), (1, 3, "o3", "d2", "x", "sell", 500, False, 100, 200, 50, 300),
        (1, 4, "o4", "d2", "x", "buy", 50, False, 100, 200, 50, 5000), (1, 5, "o5", "d2", "y", "buy", 100_000, False, 100, 200, 50, 500_000), (1, 6, "o6", "d3", "x", "buy", 100, True, 100, 200, 50, 500), (1, 7, "o7", "d3", "x", "buy", 100, False, 199, 200, 50, 500),
    ]
    orders = spark.createDataFrame(rows, "account bigint, seq bigint, order_id string, day string, code string, side string, quantity bigint, paused boolean, open_units bigint, high_limit_units bigint, low_limit_units bigint, capacity bigint")
    out = {r.order_id: r for r in ledger.simulate_cash(orders, trading.CashPolicy(), 1_000_000).collect()}
    assert (out["o1"].status, out["o1"].filled, out["o1"].price_units) == ("filled", 1000, 101)
    assert (out["o2"].status, out["o2"].reason) == ("rejected", "t1_sell_blocked")
    assert (out["o3"].status, out["o3"].filled, out["o3"].price_units) == ("partially_filled", 300, 99)
    assert out["o4"].reason == "invalid_lot" and out["o6"].reason == "suspended" and out["o7"].reason == "limit_up_buy_blocked"
    assert out["o5"].status == "partially_filled" and out["o5"].cash_units >= 0 and out["o5"].cash_units < 101 * 100 + 600
    bought = sum((1 if o.side == "buy" else -1) * o.notional_units + o.fee_units for o in out.values())
    assert out["o7"].cash_units == 1_000_000 - bought


def test_rolls(spark):
    rows = [(1, None, "a", False, 0, 3), (2, "a", "b", True, 3, -2), (3, "b", "b", False, -2, 4), (4, "b", "b", False, 4, 4), (5, "b", "b", False, 4, 1), (6, "b", "b", False, 1, 5), (7, "b", "c", True, 0, 0)]
    legs = trading.decompose_roll(spark.createDataFrame(rows, "k int, old_contract string, new_contract string, roll boolean, held bigint, target bigint")).orderBy("k", "leg").collect()
    assert [(r.k, r.contract, r.side, r.contracts, r.offset) for r in legs] == [(1, "a", "buy", 3, "open"), (2, "a", "sell", 3, "close_yesterday"), (2, "b", "sell", 2, "open"), (3, "b", "buy", 2, "close_today"), (3, "b", "buy", 4, "open"), (5, "b", "sell", 3, "close_today"), (6, "b", "buy", 4, "open")]
    assert "without a roll" in fails(trading.decompose_roll(spark.createDataFrame([(1, "a", "b", False, 1, 1)], "k int, old_contract string, new_contract string, roll boolean, held bigint, target bigint")))


def test_transitions_that_are_not_allowed(spark):
    run = lambda s, a, n: trading.transition(spark.createDataFrame([(s, a, 10, 4, n)], "status string, action string, quantity int, filled int, fill_quantity int"))
    assert run("accepted", "fill", 6).collect()[0].next_status == "filled"
    assert run("partially_filled", "cancel", 0).collect()[0].next_status == "cancelled"
    for bad in (("filled", "cancel", 0), ("accepted", "fill", 7), ("created", "fill", 1), ("accepted", "accept", 0), ("accepted", "fill", 0)):
        assert "may not change" in fails(run(*bad))


def test_a_clean_result_has_no_findings(spark):
    orders = spark.createDataFrame([("o", "i", 10, 10, "filled")], "order_id string, instrument_id string, requested_quantity bigint, filled_quantity bigint, status string")
    fills = spark.createDataFrame([("f", "o", "i", 10, 7, 1, 70, 5)], "fill_id string, order_id string, instrument_id string, quantity bigint, execution_price_units bigint, contract_multiplier int, notional_units bigint, fee_units bigint")
    costs = spark.createDataFrame([("c", "f", 3), ("d", "f", 2)], "cost_id string, fill_id string, amount_units bigint")
    assert checks.fill_integrity(orders, fills).count() == checks.order_closure(orders, fills).count() == checks.fee_closure(fills, costs).count() == 0
    assert [r.check for r in checks.fill_integrity(orders.limit(0), fills).collect()] == ["fill_reference"]
    assert {r.check for r in checks.fee_closure(fills, costs.unionAll(spark.createDataFrame([("e", "zz", 1)], costs.schema))).collect()} == {"cost_reference"}
