"""Queries against their DuckDB text on small tables with odd rows: full days, zero prices, shared codes."""

import cProfile
from datetime import datetime, timedelta

import duckdb
import pytest

from pyspark.sql import functions as F

from tidemark.functions.scalars import ratio
from tidemark.operators import checks, ledger, simulation, trading
from tests.test_oracle import QUERIES, SF, SQL, rows

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
DAY = datetime(2024, 1, 2)


def plain(found):
    """Rows with NaN as text, which is not null."""
    return [tuple("nan" if v != v else v for v in r) for r in found]


@pytest.fixture
def differing(spark, tmp_path):
    """Rows of a query that the SQL lacks, and the other way round, with some tables of its own."""

    def run(name, **tables):
        folder = tmp_path / name
        duck = duckdb.connect()
        duck.execute("SET timezone = 'UTC'")
        for t in "region nation customer supplier part orders lineitem events".split():
            df = tables[t] if t in tables else spark.read.parquet(f"{SF}/{t}.parquet")
            df.write.parquet(f"{folder}/{t}.parquet")
            duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
        df = QUERIES[name](spark, str(folder))
        found = duck.execute(SQL[name])
        columns = [c[0] for c in found.description]
        got, want = rows(df.columns, plain(df.collect())), rows(columns, plain(found.fetchall()))
        return [r for r in got if r not in want], [r for r in want if r not in got], len(got) - len(want)

    return run


def events(spark, ticks):
    """Events from (time, user, value), views and purchases by turns."""
    return spark.createDataFrame([(n, ts, user, ("view", "purchase")[n % 2], float(value), "{}") for n, (ts, user, value) in enumerate(ticks)], EVENTS)


def test_an_instrument_without_missing_slots_is_listed(spark, differing):
    whole = [(DAY + timedelta(minutes=k, seconds=1), 1, 5) for k in range(1440)]
    some = [(DAY + timedelta(hours=k), 2, 5) for k in range(5)] + [(DAY + timedelta(hours=30, minutes=7), 2, 5)]
    assert differing("bars_expected_slots", events=events(spark, whole + some)) == ([], [], 0)


@pytest.mark.parametrize("name", ["result_findings", "result_gates"])
def test_a_result_is_simulated_once(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") <= 1


def test_a_simulated_order_takes_few_calls(monkeypatch):
    """The fold of a result's orders is most of its time: at most 40 calls for each."""
    found = {}
    monkeypatch.setattr(ledger, "fold", lambda *a, **k: found.update(start=a[3]))
    ledger.simulate_cash(None, trading.CashPolicy(lot=20, slippage_units=0), 10_000_000_000_000, ["day", "seq"], True, {})
    step, _ = found["start"](1)
    rows_ = [{"seq": k, "order_id": str(k), "day": str(k // 4), "code": str(k % 7), "side": "buy", "quantity": 20, "paused": False, "open_units": 900, "high_limit_units": 901, "low_limit_units": 0, "capacity": 20} for k in range(400)]
    watch = cProfile.Profile()
    watch.enable()
    filled = [step(r)[0][6] for r in rows_]
    watch.disable()
    assert filled == [20] * 400
    assert sum(e.callcount for e in watch.getstats()) < 40 * 400


def test_ids_belong_to_a_portfolio(spark):
    orders = spark.createDataFrame([(p, "o", i, 10, 10, "filled") for p, i in ((1, "a"), (2, "b"))], "portfolio_id bigint, order_id string, instrument_id string, requested_quantity bigint, filled_quantity bigint, status string")
    fills = spark.createDataFrame([(p, "f", "o", i, 10, 7, 1, 70, p) for p, i in ((1, "a"), (2, "b"))], "portfolio_id bigint, fill_id string, order_id string, instrument_id string, quantity bigint, execution_price_units bigint, contract_multiplier int, notional_units bigint, fee_units bigint")
    costs = spark.createDataFrame([(p, "c", "f", p) for p in (1, 2)], "portfolio_id bigint, cost_id string, fill_id string, amount_units bigint")
    found = [r for df in (checks.fill_integrity(orders, fills), checks.order_closure(orders, fills), checks.fee_closure(fills, costs)) for r in df.collect()]
    assert found == []
    assert [tuple(r) for r in checks.fee_closure(fills.where("portfolio_id = 1"), costs).collect()] == [("cost_reference", "c", None, "f")]
    assert [tuple(r) for r in checks.fill_integrity(orders.where("portfolio_id = 2"), fills).collect()] == [("fill_reference", "f", None, "a")]


def test_margin_beyond_the_equity_is_a_free_equity_below_zero(spark, differing):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").crossJoin(spark.range(20)).withColumn("l_suppkey", F.col("l_suppkey") + 10 * F.col("id")).withColumn("l_quantity", F.col("l_quantity") * 100)
    assert differing("futures_portfolio", lineitem=lines.drop("id")) == ([], [], 0)
    parts = spark.createDataFrame([(DAY.date(), 5, 1, 200)], "session date, pnl_units bigint, fee_units bigint, margin_units bigint")
    assert [r.free_equity_units for r in simulation.combine_products(parts, 100, strict=False).collect()] == [-95]


def zeros(days, users=6):
    """One event an hour on some days; users' values are zero at times of their own."""
    return [(datetime(2024, 1, n, h, 5 * (u % 3), u), u, 0 if (n * 24 + h + u) % (u + 2) == 0 else n + h + u) for n in days for h in range(24) for u in range(users)]


ZEROS = {
    "example_cross_section": lambda: [(datetime(2024, 1, n, 12), u, (u * n) % 3) for n in (8, 9, 10) for u in range(1, 9)],
    "example_event_study": lambda: zeros(range(2, 9)),
    "example_time_series": lambda: [(datetime(2024, 1, n, h), u, (u * n + h) % 3) for n in (3, 15, 16) for h in (9, 10) for u in range(1, 9)],
    "features_intraday": lambda: zeros((2, 3)),
    "label_forward": lambda: zeros((2,)),
    "labels_intraday": lambda: [(DAY + timedelta(minutes=15 * k, seconds=u), u, (k * u) % 4) for k in range(60) for u in range(1, 4)],
    "labels_next_open": lambda: [(DAY + timedelta(minutes=15 * k, seconds=u), u, (k * u + 3) % 4) for k in range(60) for u in range(1, 4)],
    "signals_intraday": lambda: zeros((2, 3)),
}


@pytest.mark.parametrize("name", sorted(ZEROS))
def test_a_return_from_zero_is_that_of_the_sql(spark, differing, name):
    assert differing(name, events=events(spark, ZEROS[name]())) == ([], [], 0)


@pytest.mark.parametrize("name", ["labels_intraday", "labels_next_open"])
def test_a_return_between_two_roundings_is_that_of_the_sql(spark, differing, name):
    """57.63 / 6.40 - 1 is 8.0046875, which times 10^6 is a double below its half."""
    ticks = [(DAY + timedelta(minutes=15 * k, seconds=u), u, v) for u, last in enumerate((57.63, 3.17, 9.63, 12.81), 1) for k, v in enumerate((5, 6.40, 5, last))]
    assert differing(name, events=events(spark, ticks)) == ([], [], 0)


def test_ratio_is_that_of_ieee_754(spark):
    inf, nan = float("inf"), float("nan")
    rows = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (1.0, -0.0), (0.0, 0.0), (nan, 0.0), (inf, 0.0), (6.0, 4.0), (None, 0.0), (1.0, None)], "a double, b double")
    got = [str(r[0]) for r in rows.select(ratio(F.col("a"), F.col("b"))).collect()]
    assert got == ["inf", "-inf", "-inf", "nan", "nan", "inf", "1.5", "None", "None"]


def test_the_newest_fact_is_that_of_value_and_id_together(spark, differing):
    """More than 10 000 ids outweigh a hundredth of value; at 10 000 the greater value stands."""
    ids = [(1, 0.05, "view"), (9_000, 0.04, "view"), (10_001, 0.04, "view"), (10_001 + 1, 0.0, "purchase"), (10_500, 0.04, "view"), (10_501, 0.0, "purchase"), (40_000, 0.02, "view"), (40_001, 0.0, "purchase")]
    rows_ = [(n, DAY + timedelta(seconds=n), 1, kind, value, "{}") for n, value, kind in ids]
    assert differing("asof_versions", events=spark.createDataFrame(rows_, EVENTS).coalesce(1)) == ([], [], 0)


def test_a_code_with_two_targets_has_two_deltas(spark, differing):
    """Code 100 010 is held, and 10 too: its targets are half of what is held, and the 10 that code 10 asks for; one is sold, one bought."""
    lines = [(1, 5, 1, 3.0), (1, 100_005, 2, 8.0), (1, 7, 3, 4.0)]
    columns = spark.read.parquet(f"{SF}/lineitem.parquet").schema
    whole = spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double").selectExpr(
        "l_orderkey", "l_partkey + if(l_partkey = 100005, 5, 0) as l_partkey", "1L as l_suppkey", "l_linenumber", "l_quantity", "1D as l_extendedprice", "0D as l_discount", "0D as l_tax", "'N' as l_returnflag", "'O' as l_linestatus", "timestamp_ntz'1998-01-01' as l_shipdate"
    )
    whole = whole.unionByName(whole.where("l_partkey = 5").withColumn("l_partkey", F.lit(10).cast("bigint")))
    assert set(whole.columns) == set(columns.names)
    orders = spark.read.parquet(f"{SF}/orders.parquet").limit(1).withColumn("o_orderkey", F.lit(1).cast("bigint"))
    assert differing("rebalance_order", lineitem=whole, orders=orders) == ([], [], 0)
