"""Conservation checks of trading results: what must add up, as rows of what does not.

Tables: orders, fills, costs, cash, positions, valuations with the columns named in each check.
Every check returns (check, key, expected, stated) rows, empty when all is well. Ids belong to a
portfolio where all tables of a check have one. Tables are stacked and compared in windows, so that
a result that lies by portfolio is checked where it lies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WIDE = "decimal(38,0)"


def _rows(df: DataFrame, check: str, key: str, expected, stated) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.col(key).cast("string").alias("key"), expected.cast("string").alias("expected"), stated.cast("string").alias("stated"))


def _stacked(parents: DataFrame, children: DataFrame, key: str) -> tuple[DataFrame, Window]:
    """Rows of two tables over each other (``__child`` tells which), with the window of all rows of a ``key``."""
    scope = [c for c in ("portfolio_id",) if c in parents.columns and c in children.columns]
    rows = parents.withColumn("__child", F.lit(False)).unionByName(children.withColumn("__child", F.lit(True)), allowMissingColumns=True)
    return rows, Window.partitionBy(*scope, key)


def fill_integrity(orders: DataFrame, fills: DataFrame) -> DataFrame:
    """Every fill names an order of its instrument, and notional = price * quantity * multiplier.

    Where an order id repeats, a fill is compared with the least and the greatest of its instruments.
    """
    scope = [c for c in ("portfolio_id",) if c in orders.columns and c in fills.columns]
    rows, w = _stacked(orders.select(*scope, "order_id", "instrument_id"), fills.select(*scope, "order_id", "instrument_id", "fill_id"), "order_id")
    ordered = F.when(~F.col("__child") & F.col("order_id").isNotNull(), F.col("instrument_id"))
    rows = rows.withColumn("__low", F.min(ordered).over(w)).withColumn("__high", F.max(ordered).over(w)).where("__child")
    wrong = rows.withColumn("__i", F.explode(F.array_distinct(F.array("__low", "__high")))).where(~F.col("__i").eqNullSafe(F.col("instrument_id")))
    product = (F.col("execution_price_units").cast("decimal(19,0)") * F.col("quantity").cast("decimal(19,0)")).cast(WIDE) * F.col("contract_multiplier")
    off = fills.where(~product.cast(WIDE).eqNullSafe(F.col("notional_units").cast(WIDE)))
    return _rows(wrong, "fill_reference", "fill_id", F.col("__i"), F.col("instrument_id")).unionByName(_rows(off, "fill_notional", "fill_id", product.cast(WIDE), F.col("notional_units")))


def order_closure(orders: DataFrame, fills: DataFrame) -> DataFrame:
    """An order's filled quantity is the sum of its fills, and its status follows."""
    scope = [c for c in ("portfolio_id",) if c in orders.columns and c in fills.columns]
    rows, w = _stacked(orders.select(*scope, "order_id", "requested_quantity", "filled_quantity", "status"), fills.select(*scope, "order_id", "quantity"), "order_id")
    filled = F.sum(F.when(F.col("order_id").isNotNull(), F.col("quantity"))).over(w)
    both = rows.withColumn("__filled", F.coalesce(filled, F.lit(0))).where("not __child")
    status = F.when(F.col("__filled") == 0, F.col("status")).when(F.col("__filled") == F.col("requested_quantity"), F.lit("filled")).otherwise(F.when(F.col("status") == "filled", F.lit("partially_filled")).otherwise(F.col("status")))
    a = both.where(F.col("__filled") != F.col("filled_quantity"))
    b = both.where(~status.eqNullSafe(F.col("status")) | ((F.col("__filled") == 0) & (F.col("status") == "filled")))
    return _rows(a, "order_filled", "order_id", F.col("__filled"), F.col("filled_quantity")).unionByName(_rows(b, "order_status", "order_id", status, F.col("status")))


def fee_closure(fills: DataFrame, costs: DataFrame) -> DataFrame:
    """A fill's fee is the sum of its costs; costs name fills."""
    scope = [c for c in ("portfolio_id",) if c in fills.columns and c in costs.columns]
    rows, w = _stacked(fills.select(*scope, "fill_id", "fee_units"), costs.select(*scope, "fill_id", "cost_id", "amount_units"), "fill_id")
    named = F.col("fill_id").isNotNull()
    rows = rows.withColumn("__paid", F.sum(F.when(named, F.col("amount_units"))).over(w)).withColumn("__fills", F.count_if(named & ~F.col("__child")).over(w))
    off = ~F.col("__child") & ~F.col("__paid").eqNullSafe(F.col("fee_units").cast("bigint"))
    lost = F.col("__child") & (F.col("__fills") == 0)
    fee = F.struct(F.lit("fill_fee").alias("check"), F.col("fill_id").cast("string").alias("key"), F.col("__paid").cast("string").alias("expected"), F.col("fee_units").cast("string").alias("stated"))
    cost = F.struct(F.lit("cost_reference").alias("check"), F.col("cost_id").cast("string").alias("key"), F.lit(None).cast("string").alias("expected"), F.col("fill_id").cast("string").alias("stated"))
    return rows.where(off | lost).select(F.when(off, fee).otherwise(cost).alias("f")).select("f.*")


def cash_conservation(cash: DataFrame) -> DataFrame:
    """Opening cash and the running sum of changes is the stated total after every snapshot."""
    w = Window.partitionBy("portfolio_id").orderBy("valuation_time", "snapshot_id").rowsBetween(Window.unboundedPreceding, 0)
    change = F.sum((F.col("trade_cash_change_units") + F.col("non_trade_cash_change_units")).cast(WIDE)).over(w)
    rows = cash.withColumn("__expected", F.first("opening_cash_units").over(w) + change)
    return _rows(rows.where(~F.col("__expected").cast(WIDE).eqNullSafe(F.col("total_cash_units").cast(WIDE))), "cash_running", "snapshot_id", F.col("__expected").cast(WIDE), F.col("total_cash_units"))


def position_conservation(positions: DataFrame) -> DataFrame:
    """The running sum of quantity changes is the stated quantity, and its buckets add up to it."""
    w = Window.partitionBy("portfolio_id", "instrument_id").orderBy("valuation_time", "snapshot_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = positions.withColumn("__expected", F.sum(F.col("trade_quantity_change") + F.col("non_trade_quantity_change")).over(w))
    buckets = F.col("sellable_quantity") + F.col("unsettled_quantity") + F.col("frozen_quantity")
    a = rows.where(~F.col("__expected").eqNullSafe(F.col("quantity").cast("bigint")))
    b = rows.where(buckets != F.col("quantity"))
    return _rows(a, "position_running", "snapshot_id", F.col("__expected"), F.col("quantity")).unionByName(_rows(b, "position_buckets", "snapshot_id", buckets, F.col("quantity")))


def valuation_closure(cash: DataFrame, positions: DataFrame, valuations: DataFrame) -> DataFrame:
    """NAV is cash and the market value of positions, for every portfolio and time either side states."""
    keys = ["portfolio_id", "valuation_time"]
    held = positions.groupBy(*keys).agg(F.sum("market_value_units").alias("__held"))
    both = cash.select(*keys, "total_cash_units").join(valuations.select(*keys, "nav_units"), keys, "full_outer").join(held, keys, "left")
    expected = F.col("total_cash_units") + F.coalesce("__held", F.lit(0))
    rows = both.withColumn("__key", F.concat_ws("@", F.col("portfolio_id").cast("string"), F.col("valuation_time").cast("string")))
    return _rows(rows.where(~expected.eqNullSafe(F.col("nav_units").cast("bigint"))), "valuation", "__key", expected, F.col("nav_units"))


def daily_fill_positions(fills: DataFrame) -> DataFrame:
    """Signed quantity of each portfolio, instrument and session, and the running holding."""
    signed = F.sum(F.when(F.col("side") == "buy", F.col("quantity")).otherwise(-F.col("quantity")))
    day = fills.groupBy("portfolio_id", "instrument_id", "session").agg(signed.alias("quantity_change"))
    w = Window.partitionBy("portfolio_id", "instrument_id").orderBy("session").rowsBetween(Window.unboundedPreceding, 0)
    return day.withColumn("holding", F.sum("quantity_change").over(w))


def fills_without_snapshot(fills: DataFrame, positions: DataFrame) -> DataFrame:
    """(portfolio, instrument, session) of fills for which no position is stated."""
    keys = ["portfolio_id", "instrument_id", "session"]
    return fills.select(*keys).subtract(positions.select(*keys))


def minute_context(bars: DataFrame, targets: DataFrame, fills: DataFrame, slippage: int) -> DataFrame:
    """Minute fills against what they were made of: their bar, its price, the target before it.

    ``bars``: account, code, bar_start, dt, open_units; ``targets``: account, code, decision_time;
    ``fills``: account, seq, code, at (their bar's end), side, price_units.
    """
    key = F.concat_ws(":", "account", "seq")
    b = bars.select(F.col("account").alias("__a"), F.col("code").alias("__c"), F.col("dt").alias("__dt"), F.col("bar_start").alias("__start"), F.col("open_units").alias("__open"))
    first = targets.groupBy(F.col("account").alias("__ta"), F.col("code").alias("__tc")).agg(F.min("decision_time").alias("__decided"))
    rows = fills.join(b, (F.col("account") == F.col("__a")) & (F.col("code") == F.col("__c")) & (F.col("at") == F.col("__dt")), "left")
    rows = rows.join(first, (F.col("account") == F.col("__ta")) & (F.col("code") == F.col("__tc")), "left").withColumn("__key", key)
    price = F.col("__open") + F.when(F.col("side") == "buy", slippage).otherwise(-slippage)
    early = F.col("__dt").isNotNull() & ~F.coalesce(F.col("__decided") <= F.col("__start"), F.lit(False))
    out = _rows(rows.where("__dt is null"), "minute_bar", "__key", F.lit(None), F.col("at"))
    out = out.unionByName(_rows(rows.where(price != F.col("price_units")), "minute_price", "__key", price, F.col("price_units")))
    return out.unionByName(_rows(rows.where(early), "minute_target", "__key", F.col("__decided"), F.col("__start")))


def recomputed(stated: DataFrame, again: DataFrame, keys: list[str]) -> DataFrame:
    """Findings where a table differs from a second, independent computation of it, value by value."""
    values = [c for c in stated.columns if c not in keys]
    a = stated.select(*[F.col(k).alias(f"__{k}") for k in keys], F.struct(*values).alias("__stated"))
    both = again.select(*keys, F.struct(*values).alias("__again")).join(a, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "full_outer")
    named = both.withColumn("__key", F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.col(f"__{k}").cast("string")) for k in keys]))
    each = [F.when(~F.col(f"__again.{v}").eqNullSafe(F.col(f"__stated.{v}")), F.struct(F.lit(v).alias("check"), F.col("__key").alias("key"), F.col(f"__again.{v}").cast("string").alias("expected"), F.col(f"__stated.{v}").cast("string").alias("stated"))) for v in values]
    return named.select(F.explode(F.array_compact(F.array(*each))).alias("f")).select("f.*")


class Workspace:
    """Tables that verifying SQL may read, by name in braces, and how many rows an answer may have."""

    def __init__(self, tables: dict[str, DataFrame], max_rows: int = 1_000_000):
        self.tables, self.max_rows = tables, max_rows

    def sql(self, text: str) -> DataFrame:
        from tidemark.operators.query import within_rows

        spark = next(iter(self.tables.values())).sparkSession
        return within_rows(spark.sql(text, **{n: df for n, df in self.tables.items() if "{" + n + "}" in text}), self.max_rows)
