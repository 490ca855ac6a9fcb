"""Trading rules as expressions: tradability, prices, fees, margin, targets, corporate actions, cost analysis.

Money is in integer units (``bigint``); products that may pass 63 bits are ``decimal(38,0)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.functions.scalars import PPM, ceil_ratio, floor_ratio
from tidemark.operators.pit import guard, interval_join


@dataclass(frozen=True)
class CashPolicy:
    """Costs and rules of a cash market."""

    lot: int = 100
    commission_ppm: int = 300
    minimum_commission: int = 500
    transfer_ppm: int = 10
    sell_tax_ppm: int = 1000
    slippage_units: int = 1
    settlement_days: int = 1
    cut_to_cash: bool = True

    def __post_init__(self) -> None:
        if self.lot < 1 or min(self.commission_ppm, self.minimum_commission, self.transfer_ppm, self.sell_tax_ppm, self.slippage_units) < 0:
            raise ContractError("costs are not negative and a lot has at least one share")

    # the same rules on Python integers, for folds
    def fee(self, side: str, notional: int) -> int:
        short = -notional
        commission = -(short * self.commission_ppm // PPM)
        out = (commission if commission > self.minimum_commission else self.minimum_commission) - short * self.transfer_ppm // PPM
        return out - short * self.sell_tax_ppm // PPM if side == "sell" else out

    def affordable(self, cash: int, wanted: int, price: int) -> int:
        """The most lots, in shares, that cash pays for with fees: the estimate without fees, lowered until it fits."""
        lots = min(wanted, max(0, cash) // price) // self.lot
        while lots:
            notional = lots * self.lot * price
            over = notional + self.fee("buy", notional) - cash
            if over <= 0:
                break
            lots -= max(1, over // (self.lot * price + self.fee("buy", self.lot * price)))
        return max(lots, 0) * self.lot


def execution_price(side: Column, reference: Column, policy: CashPolicy) -> Column:
    """Reference price with slippage against the order."""
    return F.when(side == "buy", reference + policy.slippage_units).otherwise(reference - policy.slippage_units)


def fee_units(side: Column, notional: Column, policy: CashPolicy) -> Column:
    """max(minimum, ceil(commission)) + ceil(transfer) + ceil(tax, on sells)."""
    up = lambda ppm: ceil_ratio(notional * ppm, PPM)
    return F.greatest(F.lit(policy.minimum_commission).cast("bigint"), up(policy.commission_ppm)) + up(policy.transfer_ppm) + F.when(side == "sell", up(policy.sell_tax_ppm)).otherwise(F.lit(0).cast("bigint"))


def tradability(orders: DataFrame, lot: int = 100, at_limit: bool = True) -> DataFrame:
    """``allowed`` and the first reason against, of orders joined to their day's reference row.

    Columns: side, quantity, paused, open, high_limit, low_limit, sellable.
    """
    c = F.col
    bad = lambda x: c(x).isNull() | F.isnan(c(x).cast("double")) | (c(x) <= 0)
    buy, sell = c("side") == "buy", c("side") == "sell"
    reason = (
        F.when(c("quantity") < lot, "below_lot_size")
        .when(c("paused"), "suspended")
        .when(bad("open"), "invalid_trade_price")
        .when(buy & bad("high_limit"), "invalid_limit_price")
        .when(sell & bad("low_limit"), "invalid_limit_price")
        .when(F.lit(at_limit) & buy & (c("open") >= c("high_limit")), "limit_up_buy_blocked")
        .when(F.lit(at_limit) & sell & (c("open") <= c("low_limit")), "limit_down_sell_blocked")
        .when(sell & (c("sellable") < c("quantity")), "t1_sell_blocked")
    )
    return orders.withColumn("reason_code", reason).withColumn("allowed", F.col("reason_code").isNull())


def reject_reason(orders: DataFrame, policy: CashPolicy) -> DataFrame:
    """``reject_reason`` of cash orders against their opening snapshot, null where they may trade.

    Columns: side, quantity, paused, open_units, high_limit_units, low_limit_units, limit_units, sellable.
    """
    c = F.col
    price = execution_price(c("side"), c("open_units"), policy)
    buy, sell = c("side") == "buy", c("side") == "sell"
    odd = F.pmod(c("quantity"), F.lit(policy.lot))
    whole_rest = sell & (odd == F.pmod(c("sellable"), F.lit(policy.lot)))
    reason = (
        F.when((odd != 0) & ~whole_rest, "invalid_lot")
        .when(c("paused"), "suspended")
        .when(buy & (price >= c("high_limit_units")), "limit_up_buy_blocked")
        .when(sell & (price <= c("low_limit_units")), "limit_down_sell_blocked")
        .when(buy & (price > c("limit_units")), "limit_price_not_reached")
        .when(sell & (price < c("limit_units")), "limit_price_not_reached")
        .when(sell & (c("sellable") < c("quantity")), "t1_sell_blocked" if policy.settlement_days == 1 else "insufficient_position")
    )
    return orders.withColumn("execution_units", price).withColumn("reject_reason", reason)


def target_quantity(nav: Column, weight_ppm: Column, price: Column, lot: int) -> Column:
    """floor(nav * weight / price), down to a lot."""
    worth = floor_ratio((nav.cast("decimal(38,0)") * weight_ppm).cast("decimal(38,0)"), PPM)
    shares = F.floor(worth / price).cast("bigint")
    return shares - F.pmod(shares, F.lit(lot))


def net_asset_value(cash: DataFrame, positions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cash and the market value of positions by ``keys``; either side may be missing."""
    value = positions.groupBy(*keys).agg(F.sum(F.col("quantity") * F.col("price_units")).alias("market_value_units"))
    both = cash.groupBy(*keys).agg(F.sum("cash_units").alias("cash_units")).join(value, list(keys), "full_outer")
    both = both.fillna(0, ["cash_units", "market_value_units"])
    return both.withColumn("nav_units", F.col("cash_units") + F.col("market_value_units"))


def participation_cap(volume: Column, ppm: int, used: Column, lot: int) -> Column:
    """What may still trade of a bar's volume, down to a lot."""
    left = floor_ratio(volume * ppm, PPM) - used
    left = F.greatest(left, F.lit(0))
    return left - F.pmod(left, F.lit(lot))


# Futures ---------------------------------------------------------------------------------------


def margin_units(contracts: Column, price: Column, multiplier: Column, rate_ppm: Column) -> Column:
    """ceil(|contracts| * price * multiplier * rate)."""
    return ceil_ratio((F.abs(contracts) * price * multiplier).cast("bigint") * rate_ppm, PPM)


def futures_fee(offset: Column, contracts: Column, rates: dict[str, int]) -> Column:
    """Fee for each contract by offset; an unknown offset is an error."""
    table = F.create_map(*[x for k, v in rates.items() for x in (F.lit(k), F.lit(v).cast("bigint"))])
    rate = F.try_element_at(table, offset)
    return F.abs(contracts) * F.when(rate.isNotNull(), rate).otherwise(F.raise_error(F.lit("no fee for an offset")).cast("bigint"))


def settle_day(positions: DataFrame, entity: Sequence[str], day: str) -> DataFrame:
    """Daily mark to market: contracts * (settlement - previous settlement) * multiplier."""
    w = Window.partitionBy(*entity).orderBy(day)
    before = F.coalesce(F.lag("settlement_units").over(w), F.col("settlement_units"))
    held = F.coalesce(F.lag("contracts").over(w), F.lit(0))
    return positions.withColumn("previous_settlement_units", before).withColumn("pnl_units", held * (F.col("settlement_units") - F.col("previous_settlement_units")) * F.col("multiplier"))


def margin_calls(accounts: DataFrame) -> DataFrame:
    """Accounts whose equity is under their maintenance margin."""
    return accounts.where(F.col("equity_units") < F.col("maintenance_units"))


def contract_at(signals: DataFrame, mappings: DataFrame, as_of: Column) -> DataFrame:
    """The one actual contract of (continuous, signal_date) visible at ``as_of``; none or two are errors."""
    seen = mappings.where(F.col("available") <= as_of).groupBy("continuous", "signal_date").agg(F.count(F.lit(1)).alias("__n"), F.max("contract").alias("contract"), F.max("roll").alias("roll"))
    rows = signals.join(seen, ["continuous", "signal_date"], "left")
    return rows.where(guard(F.coalesce(F.col("__n") == 1, F.lit(False)), "a continuous contract has no mapping, or several")).drop("__n")


def decompose_roll(rows: DataFrame) -> DataFrame:
    """Orders that take an account from its old contract and position to the new ones.

    Columns: old_contract (null at first), new_contract, roll, held, target. A changed contract that
    is no roll is an error. One row for each leg: contract, side, contracts, offset, leg.
    """
    c = F.col
    side = lambda n: F.when(n > 0, F.lit("buy")).otherwise(F.lit("sell"))
    leg = lambda contract, n, offset: F.struct(contract.alias("contract"), side(n).alias("side"), F.abs(n).cast("bigint").alias("contracts"), F.lit(offset).alias("offset"))
    first, changed = c("old_contract").isNull(), c("old_contract") != c("new_contract")
    rows = rows.where(guard(~F.coalesce(changed, F.lit(False)) | c("roll"), "the contract changed without a roll"))
    delta = c("target") - c("held")
    reverse = (c("held") * c("target")) < 0
    opens = (c("held") == 0) | (F.abs("target") > F.abs("held"))
    same = F.when(delta == 0, F.array()).when(opens, F.array(leg(c("new_contract"), delta, "open"))).otherwise(F.array(leg(c("new_contract"), delta, "close_today")))
    two = lambda closing, old: F.array(leg(old, -c("held"), closing), leg(c("new_contract"), c("target"), "open"))
    legs = F.when(first, F.array(leg(c("new_contract"), c("target"), "open"))).when(changed, two("close_yesterday", c("old_contract"))).when(reverse, two("close_today", c("new_contract"))).otherwise(same)
    out = rows.withColumn("__legs", F.filter(legs, lambda x: x["contracts"] > 0))
    return out.select("*", F.posexplode("__legs").alias("leg", "__leg")).select(*rows.columns, "leg", "__leg.*").drop("__legs")


def rule_at(facts: DataFrame, rules: DataFrame, on: Sequence[str], day: str, as_of: Column) -> DataFrame:
    """The one rule visible at ``as_of`` that is in force on a day; both ends of its interval count."""
    seen = rules.where(F.col("available") <= as_of).drop("available").withColumn("__rule", F.lit(1))
    rows = interval_join(facts, seen, on, day, "valid_from", "valid_to", closed_end=True)
    n = F.count(F.lit(1)).over(Window.partitionBy(*facts.columns))
    rows = rows.withColumn("__n", n)
    return rows.where(guard((F.col("__n") == 1) & F.col("__rule").isNotNull(), "a day has no rule, or several")).drop("__n", "__rule")


# Corporate actions -----------------------------------------------------------------------------


def compile_actions(actions: DataFrame, effective_time: Column) -> DataFrame:
    """Ledger effects of corporate actions on held quantities.

    Columns: kind, held, cash_per_share_units, cash_per_share_micro, ratio_numerator,
    ratio_denominator, exercise_price_units, exercised, announced, effective_date, pay_date. Rights
    without an instruction and code changes have no effect and no row. What pays after the effective
    date becomes a receivable (cash) or an entitlement (shares).
    """
    c = F.col
    known = guard(c("announced") <= effective_time, "an action is not visible yet")
    ratio = floor_ratio(c("held") * c("ratio_numerator"), c("ratio_denominator"))
    micro = F.round((c("held").cast("decimal(28,0)") * c("cash_per_share_micro")).cast("decimal(38,4)") / F.lit(10_000).cast("decimal(5,0)"), 0).cast("bigint")
    zero = F.lit(0).cast("bigint")
    rows = actions.where(known).where(guard(c("held") >= 0, "a held quantity is negative"))
    rows = rows.where(F.when(c("kind") == "rights", c("exercised").isNotNull()).otherwise(c("kind") != "code_change"))
    rows = rows.where(guard((c("kind") != "rights") | ((c("exercised") >= 0) & (c("exercised") <= ratio)), "rights exceed their entitlement"))
    cash = (
        F.when((c("kind") == "cash_dividend") & (c("cash_per_share_micro") != 0), micro)
        .when(c("kind").isin("cash_dividend", "delisting_cash"), c("held") * c("cash_per_share_units"))
        .when(c("kind") == "rights", -c("exercised") * c("exercise_price_units"))
        .otherwise(zero)
    )
    shares = F.when(c("kind").isin("stock_dividend", "split", "reverse_split"), ratio - c("held")).when(c("kind") == "rights", c("exercised")).when(c("kind") == "delisting_cash", -c("held")).otherwise(zero)
    rows = rows.withColumn("__cash", cash).withColumn("__shares", shares)
    later = c("pay_date") > c("effective_date")
    owed = (c("kind") == "cash_dividend") & (c("__cash") != 0) & later
    due = c("kind").isin("stock_dividend", "split") & (c("__shares") > 0) & later
    return rows.select(
        *actions.columns,
        F.when(owed, zero).otherwise(c("__cash")).alias("cash_delta_units"), F.when(owed, c("__cash")).otherwise(zero).alias("cash_receivable_units"),
        F.when(due, zero).otherwise(c("__shares")).alias("sellable_delta"), F.when(due, c("__shares")).otherwise(zero).alias("entitlement_quantity"),
        F.when(owed | due, c("pay_date")).alias("due_date"),
    )


# Orders and cost analysis ----------------------------------------------------------------------

#: (status, action) -> next status; fixed values. ``fill`` ends in filled or partially_filled.
TRANSITIONS = {
    ("created", "submit"): "submitted",
    ("submitted", "accept"): "accepted",
    ("submitted", "reject"): "rejected",
    ("submitted", "cancel"): "cancelled",
    ("accepted", "cancel"): "cancelled",
    ("partially_filled", "cancel"): "cancelled",
    ("submitted", "expire"): "expired",
    ("accepted", "expire"): "expired",
    ("partially_filled", "expire"): "expired",
}


def transition(orders: DataFrame) -> DataFrame:
    """``next_status`` and ``next_filled`` of (status, action, quantity, filled, fill_quantity).

    A transition that is not in the table, or a fill beyond the quantity, is an error.
    """
    c = F.col
    table = F.create_map(*[x for (s, a), t in TRANSITIONS.items() for x in (F.lit(f"{s}>{a}"), F.lit(t))])
    filling = (c("action") == "fill") & c("status").isin("accepted", "partially_filled") & (c("fill_quantity") > 0)
    total = c("filled") + F.when(c("action") == "fill", c("fill_quantity")).otherwise(F.lit(0))
    plain = F.try_element_at(table, F.concat_ws(">", "status", "action"))
    status = F.when(filling & (total <= c("quantity")), F.when(total == c("quantity"), F.lit("filled")).otherwise(F.lit("partially_filled"))).otherwise(plain)
    return orders.withColumn("next_status", status).withColumn("next_filled", total).where(guard(c("next_status").isNotNull(), "an order may not change so"))


@dataclass(frozen=True)
class CostPolicy:
    """Model of a bar's trading cost."""

    spread_bps: int = 5
    impact: str = "fixed"
    fixed_bps: int = 10
    sqrt_bps: int = 50
    cap_ppm: int = 100_000
    multiplier: int = 1


def fill_costs(fills: DataFrame, policy: CostPolicy) -> DataFrame:
    """Shortfall, participation, spread and impact of fills joined to their orders.

    Columns: side, quantity, execution_units, decision_units, arrival_units, capacity, fee_units. A
    fill without an arrival price or capacity has no liquidity figures (``not_computable``).
    """
    if policy.impact not in ("fixed", "sqrt"):
        raise ContractError("impact is fixed or sqrt")
    c = F.col
    direction = F.when(c("side") == "buy", 1).otherwise(-1)
    shortfall = direction * (c("execution_units") - c("decision_units")) * c("quantity") * policy.multiplier
    known = c("arrival_units").isNotNull() & c("capacity").isNotNull()
    bps = lambda rate: F.round((c("arrival_units") * rate).cast("decimal(38,12)") / F.lit(10_000).cast("decimal(5,0)"), 0).cast("bigint")
    impact = F.lit(policy.fixed_bps).cast("decimal(18,8)") if policy.impact == "fixed" else (policy.sqrt_bps * F.sqrt(c("quantity") / c("capacity"))).cast("decimal(18,8)")
    part = floor_ratio(c("quantity") * PPM, c("capacity"))
    return (
        fills.withColumn("shortfall_units", shortfall)
        .withColumn("implementation_shortfall_units", shortfall + c("fee_units"))
        .withColumn("liquidity_status", F.when(known, "computed").otherwise("not_computable"))
        .withColumn("participation_ppm", F.when(known, part))
        .withColumn("over_cap", F.when(known, part > policy.cap_ppm))
        .withColumn("spread_units", F.when(known, bps(F.lit(policy.spread_bps)) * c("quantity") * policy.multiplier))
        .withColumn("impact_units", F.when(known, bps(impact) * c("quantity") * policy.multiplier))
    )


def cost_rollup(costs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Costs by order, day or over all; liquidity figures only if every fill has them."""
    all_known = F.every(F.col("liquidity_status") == "computed")
    return costs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("fill_count"), F.sum("shortfall_units").alias("shortfall_units"), F.sum("fee_units").alias("fee_units"), F.sum("implementation_shortfall_units").alias("implementation_shortfall_units"),
        F.when(all_known, F.lit("computed")).otherwise(F.lit("not_computable")).alias("liquidity_status"),
        F.when(all_known, F.sum("spread_units")).alias("spread_units"), F.when(all_known, F.sum("impact_units")).alias("impact_units"),
    )
