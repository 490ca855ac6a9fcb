"""Event simulations: minute targets and daily futures, their six result tables, and data audits.

Each simulated account is one ordered fold in Python; what surrounds it (choosing bars, projecting
results, audits and checks) are plans.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators import checks
from tidemark.operators.ledger import Holding, LedgerError, Spot, fill_moves, fold
from tidemark.operators.trading import CashPolicy

# Minutes ---------------------------------------------------------------------------------------

MINUTE = "account bigint, seq bigint, kind string, code string, session string, at timestamp_ntz, side string, quantity bigint, price_units bigint, fee_units bigint, reason string, cash_units bigint, position bigint, nav_units bigint"


@dataclass(frozen=True)
class MinutePolicy:
    """Execution of minute targets: costs, and the share of a bar's volume that may be traded."""

    costs: CashPolicy = CashPolicy()
    participation_ppm: int = 100_000


def next_eligible(targets: DataFrame, bars: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Targets with their decision bar: the latest completed one that ended and was visible by the decision.

    A target without such a bar, or without a later completed bar to trade in, is an error.
    """
    from tidemark.operators.pit import asof_join, guard

    done = bars.where("completed and quality_status = 'pass'").withColumn("__at", F.greatest("dt", "available_time"))
    found = asof_join(targets, done.select(*keys, "__at", F.col("dt").alias("decision_bar_end"), F.col("close_units").alias("decision_units")), keys, "decision_time", "__at", ["decision_bar_end", "decision_units"])
    last = done.groupBy(*keys).agg(F.max("bar_start").alias("__last"))
    rows = found.join(last, list(keys), "left")
    sound = F.col("decision_bar_end").isNotNull() & (F.col("__last") >= F.col("decision_time"))
    return rows.where(guard(F.coalesce(sound, F.lit(False)), "a target has no decision bar, or no bar to trade in")).drop("__last")


def simulate_minutes(bars: DataFrame, targets: DataFrame, policy: MinutePolicy, opening: int) -> DataFrame:
    """Each account's targets traded in its bars.

    ``bars``: account, code, session, bar_start, dt, available_time, seq, open_units, close_units,
    volume, completed, quality_status, high_limit_units, low_limit_units. ``targets``: account, code,
    decision_time, target_quantity. A target acts in bars that start at or after its decision, at
    their open, up to the participation cap, until the held quantity is the target. Purchases may
    be sold from the next session on. Bars come in order of availability; one that comes twice is an
    error. Rows: ``fill`` and ``reject`` as they happen, and a ``close`` for each session.
    """

    def start(account) -> tuple:
        held = MinuteAccount(account, policy, opening)
        return held.step, held.end

    return fold(minute_events(bars, targets), "account", ["time", "what", "code", "dt", "seq"], start, MINUTE)


def minute_events(bars: DataFrame, targets: DataFrame) -> DataFrame:
    """Bars and targets as one table of events: ``what`` is 0 for a target, ``time`` when it is known."""
    asked = targets.select("account", F.lit(0).alias("what"), F.col("decision_time").alias("time"), "code", "target_quantity")
    return bars.withColumn("what", F.lit(1)).withColumn("time", F.col("available_time")).unionByName(asked, allowMissingColumns=True)


class MinuteAccount:
    """One account's minute simulation: takes events in order, gives rows of MINUTE as tuples. It may be pickled between events."""

    def __init__(self, account, policy: MinutePolicy, opening: int):
        self.account, self.policy, self.state = account, policy, Spot(opening)
        self.wanted, self.active, self.prices, self.seen = deque(), {}, {}, set()
        self.session, self.last, self.position, self.worth, self.rows = None, None, 0, 0, 0

    def row(self, kind: str, b: dict, side=None, n=0, price=0, fee=0, reason=None) -> tuple:
        self.rows += 1
        return self.account, self.rows - 1, kind, b["code"], str(b["session"]), b["dt"], side, n, price, fee, reason, self.state.available, self.position, self.state.available + self.worth

    def trade(self, b: dict) -> list[tuple]:
        """Towards the target of a bar's instrument, at its open."""
        costs, lot, held = self.policy.costs, self.policy.costs.lot, self.state.lot(b["code"])
        gap = self.active.get(b["code"], held.quantity) - held.quantity
        if not gap:
            return []
        buy = gap > 0
        side, price = ("buy", b["open_units"] + costs.slippage_units) if buy else ("sell", b["open_units"] - costs.slippage_units)
        n = min(abs(gap), b["volume"] * self.policy.participation_ppm // 1_000_000) // lot * lot
        free = n if buy else min(n, held.sellable // lot * lot)
        if buy and free and n * price + costs.fee(side, n * price) > self.state.available:
            free = costs.affordable(self.state.available, n, price)
        rules = (
            ("limit_up_buy_blocked", buy and price >= b["high_limit_units"]),
            ("limit_down_sell_blocked", not buy and price <= b["low_limit_units"]),
            ("capacity_exceeded", not n),
            ("insufficient_cash" if buy else "t1_sell_blocked", not free),
        )
        if reason := next((name for name, holds in rules if holds), None):
            return [self.row("reject", b, side, abs(gap), price, 0, reason)]
        fee = costs.fee(side, free * price)
        self.state.post(fill_moves(side, b["code"], free, free * price, fee))
        change = free if buy else -free
        self.position += change
        self.worth += change * self.prices[b["code"]]
        return [self.row("fill", b, side, free, price, fee)]

    def step(self, e: dict) -> list[tuple]:
        if not e["what"]:
            self.wanted.append((e["time"], e["code"], int(e["target_quantity"])))
            return []
        if (e["code"], e["dt"]) in self.seen:
            raise LedgerError("a bar comes twice")
        self.seen.add((e["code"], e["dt"]))
        while self.wanted and self.wanted[0][0] <= e["bar_start"]:
            _, code, quantity = self.wanted.popleft()
            self.active[code] = quantity
        if not e["completed"] or e["quality_status"] != "pass":
            return []
        e = e | {k: int(e[k]) for k in ("open_units", "close_units", "volume", "high_limit_units", "low_limit_units")}
        out = []
        if e["session"] != self.session:
            if self.last is not None:
                out.append(self.row("close", self.last))
            self.state.mature()
            self.session = e["session"]
        self.worth += self.state.lot(e["code"]).quantity * (e["close_units"] - self.prices.get(e["code"], 0))
        self.prices[e["code"]], self.last = e["close_units"], e
        return out + self.trade(e)

    def end(self) -> list[tuple]:
        if self.wanted:
            raise LedgerError("a target has no later bar")
        return [self.row("close", self.last)] if self.last is not None else []


# Daily futures ---------------------------------------------------------------------------------

DAILY = "product string, seq bigint, kind string, session date, contract string, side string, quantity bigint, offset string, price_units bigint, fee_units bigint, pnl_units bigint, margin_units bigint, equity_units bigint, position bigint, reason string"


@dataclass(frozen=True)
class FuturesRules:
    multiplier: int
    margin_ppm: int
    fees: tuple[tuple[str, int], ...]
    slippage_units: int = 0


def simulate_futures(legs: DataFrame, settlements: DataFrame, rules: FuturesRules, opening: int) -> DataFrame:
    """Order legs executed at a session's open, marked to its settlement, with forced liquidation.

    ``legs``: product, session, leg, contract, side, contracts, offset, open_units, blocked.
    ``settlements``: product, session, contract, settlement_units. A blocked closing leg also keeps
    the opening legs of its session from trading. Yesterday's contracts close before today's.
    A position whose margin passes the equity is closed at the settlement.
    """
    fees = dict(rules.fees)
    orders = legs.select("product", "session", F.lit(0).alias("what"), F.col("leg").alias("n"), "contract", "side", "contracts", "offset", F.col("open_units").alias("price"), "blocked")
    marks = settlements.select("product", "session", F.lit(1).alias("what"), F.lit(0).alias("n"), "contract", F.lit(None).cast("string").alias("side"), F.lit(0).cast("bigint").alias("contracts"), F.lit(None).cast("string").alias("offset"), F.col("settlement_units").alias("price"), F.lit(False).alias("blocked"))

    def start(product) -> tuple:
        equity, n_rows, day, today, stuck = opening, 0, None, 0, False
        contract, held = None, Holding()

        def row(kind, e, side=None, quantity=0, offset=None, price=None, fee=0, pnl=0, margin=0, reason=None) -> tuple:
            nonlocal n_rows
            n_rows += 1
            return product, n_rows - 1, kind, e["session"], e["contract"], side, quantity, offset, price, fee, pnl, margin, equity, held.contracts, reason

        def leg(e: dict) -> tuple:
            nonlocal equity, contract, today, stuck
            n, opens = e["contracts"], e["offset"] == "open"
            if e["blocked"] or (stuck and opens):
                stuck = stuck or not opens
                return row("reject", e, e["side"], n, e["offset"], reason="not_tradable" if e["blocked"] else "closing_leg_blocked")
            signed = n if e["side"] == "buy" else -n
            price = e["price"] + (rules.slippage_units if signed > 0 else -rules.slippage_units)
            size = abs(held.contracts)
            if opens and size and (contract != e["contract"] or held.contracts * signed < 0):
                raise LedgerError("an opening leg needs the old position closed")
            if not opens and (contract != e["contract"] or held.contracts * signed >= 0 or n > size):
                raise LedgerError("a closing leg does not fit the position")
            if e["offset"] == "close_yesterday" and n > size - today:
                raise LedgerError("a leg closes contracts of another day")
            pnl, fee = held.trade(signed, price, rules.multiplier), n * fees[e["offset"]]
            today = today + n if opens else min(today, abs(held.contracts))
            contract = e["contract"] if held.contracts else None
            equity += pnl - fee
            return row("fill", e, e["side"], n, e["offset"], price, fee, pnl)

        def mark(e: dict) -> list[tuple]:
            nonlocal equity, contract, held
            if not held.contracts or contract != e["contract"]:
                return []
            price, n = e["price"], abs(held.contracts)
            pnl = held.mark(price, rules.multiplier)
            equity += pnl
            margin = -(-n * price * rules.multiplier * rules.margin_ppm // 1_000_000)
            out = [row("settle", e, price=price, pnl=pnl, margin=margin)]
            if margin > equity:
                side, fee = "sell" if held.contracts > 0 else "buy", n * fees["close_today" if today else "close_yesterday"]
                equity -= fee
                held, contract = Holding(), None
                out.append(row("forced", e, side, n, price=price, fee=fee, reason="margin"))
            return out

        def step(e: dict) -> list[tuple]:
            nonlocal day, today, stuck
            if e["session"] != day:
                day, today, stuck = e["session"], 0, False
            return mark(e) if e["what"] else [leg(e)]

        return step, tuple

    return fold(orders.unionByName(marks), "product", ["session", "what", "n", "contract"], start, DAILY)


def futures_intents(targets: DataFrame, sessions: DataFrame, session: str = "session") -> DataFrame:
    """Order intents of target positions: each target is traded in the next session, an old contract closed first.

    ``targets``: product, session, contract, target_quantity; ``sessions``: the calendar. Positions
    are those of days before, so that every closing leg closes yesterday's. A target that has to be
    traded without a later session is an error, and so is a product with two targets in one. Rows: product, session (of the
    execution), target_session, target_sequence, leg, contract, side, contracts, offset.
    """
    from tidemark.operators.pit import guard
    from tidemark.operators.trading import decompose_roll

    w, at = Window.partitionBy("product").orderBy("target_session"), Window.orderBy("__day")  # one row a session
    days = sessions.select(F.col(session).alias("__day")).distinct().withColumn("session", F.lead("__day").over(at))
    rows = targets.select("product", F.col("session").alias("target_session"), F.col("contract").alias("new_contract"), F.col("target_quantity").cast("bigint").alias("target"))
    rows = rows.withColumn("target_sequence", F.row_number().over(w) - 1).withColumn("__twice", F.col("target_session").eqNullSafe(F.lag("target_session").over(w)))
    rows = rows.withColumn("old_contract", F.lag("new_contract").over(w)).withColumn("held", F.coalesce(F.lag("target").over(w), F.lit(0)))
    rows = rows.withColumn("roll", F.coalesce(F.col("old_contract") != F.col("new_contract"), F.lit(False)))
    rows = rows.where(guard(~F.col("__twice"), "a product has two targets in a session")).drop("__twice")
    rows = rows.join(days, F.col("target_session") == F.col("__day"), "left").drop("__day")
    rows = rows.where(guard(F.col("session").isNotNull(), "a target has no later session"))
    legs = decompose_roll(rows)
    offset = F.when(F.col("offset") == "close_today", "close_yesterday").otherwise(F.col("offset"))
    return legs.select("product", "session", "target_session", "target_sequence", "leg", "contract", "side", "contracts", offset.alias("offset"))


def futures_contributions(simulated: DataFrame, categories: DataFrame, opening: int) -> DataFrame:
    """What each product added to a portfolio by session: its change of equity, fees and margin.

    ``simulated``: rows of :func:`simulate_futures`; ``categories``: product, category, for exactly
    the simulated products (else an error).
    """
    from tidemark.operators.pit import guard

    day = simulated.groupBy("product", "session").agg(F.max_by("equity_units", "seq").alias("equity_units"), F.sum("fee_units").alias("fee_units"), F.max_by(F.when(F.col("position") == 0, 0).otherwise(F.col("margin_units")), "seq").alias("margin_units"))
    before = F.lag("equity_units").over(Window.partitionBy("product").orderBy("session"))
    day = day.withColumn("pnl_units", F.col("equity_units") - F.coalesce(before, F.lit(opening)))
    both = day.join(categories.select(F.col("product").alias("__p"), "category"), F.col("product") == F.col("__p"), "full_outer")
    both = both.where(guard(F.col("product").isNotNull() & F.col("category").isNotNull(), "categories have to cover the simulated products, and no others"))
    return both.select("product", "category", "session", "pnl_units", "fee_units", "margin_units", "equity_units")


def combine_products(contributions: DataFrame, opening: int, strict: bool = True) -> DataFrame:
    """A portfolio by session: one opening equity and what all products added to it.

    Margin beyond the equity is an error if ``strict``, else a free equity below zero.
    """
    from tidemark.operators.pit import guard

    day = contributions.groupBy("session").agg(F.sum("pnl_units").alias("pnl_units"), F.sum("fee_units").alias("fee_units"), F.sum("margin_units").alias("margin_units"))
    total = F.sum("pnl_units").over(Window.orderBy("session").rowsBetween(Window.unboundedPreceding, 0))  # one row a session
    day = day.withColumn("equity_units", F.lit(opening) + total)
    if strict:
        day = day.where(guard(F.col("margin_units") <= F.col("equity_units"), "the products' margin passes the portfolio's equity"))
    return day.select("session", "pnl_units", "fee_units", "margin_units", "equity_units", (F.col("equity_units") - F.col("margin_units")).alias("free_equity_units"))


# Six result tables -----------------------------------------------------------------------------


def project_cash(orders: DataFrame, opening: int) -> dict[str, DataFrame]:
    """Simulated cash orders (of ``ledger.simulate_cash``, with their day) as the six result tables."""
    done = orders.where("filled > 0")
    sign = F.when(F.col("side") == "buy", 1).otherwise(-1)
    out = {
        "orders": orders.select(F.col("account").alias("portfolio_id"), "order_id", F.col("day").alias("session"), F.col("code").alias("instrument_id"), "side", F.col("requested").alias("requested_quantity"), F.col("filled").alias("filled_quantity"), "status", F.when(F.col("status") != "filled", F.col("reason")).alias("terminal_reason")),
        "fills": done.select(F.col("account").alias("portfolio_id"), F.concat("order_id", F.lit(":f")).alias("fill_id"), "order_id", F.col("day").alias("session"), F.col("code").alias("instrument_id"), "side", F.col("filled").alias("quantity"), F.col("price_units").alias("execution_price_units"), F.lit(1).alias("contract_multiplier"), "notional_units", "fee_units"),
        "costs": done.select(F.col("account").alias("portfolio_id"), F.concat("order_id", F.lit(":c")).alias("cost_id"), F.concat("order_id", F.lit(":f")).alias("fill_id"), F.lit("transaction_fee").alias("cost_type"), F.col("fee_units").alias("amount_units")),
    }
    change = -sign * F.col("notional_units") - F.col("fee_units")
    ends = orders.groupBy("account", "day").agg(F.sum(F.when(F.col("filled") > 0, change).otherwise(0)).alias("trade_cash_change_units"), *[F.max_by(c, "seq").alias(c) for c in ("cash_units", "nav_units")])
    out["cash"] = ends.select(F.col("account").alias("portfolio_id"), F.concat_ws("@", F.col("account").cast("string"), "day").alias("snapshot_id"), F.col("day").alias("valuation_time"), F.lit(opening).cast("bigint").alias("opening_cash_units"), "trade_cash_change_units", F.lit(0).cast("bigint").alias("non_trade_cash_change_units"), F.col("cash_units").alias("total_cash_units"))
    day = done.groupBy(F.col("account").alias("portfolio_id"), F.col("code").alias("instrument_id"), F.col("day").alias("valuation_time")).agg(F.sum(sign * F.col("filled")).alias("trade_quantity_change"))
    w = Window.partitionBy("portfolio_id", "instrument_id").orderBy("valuation_time").rowsBetween(Window.unboundedPreceding, 0)
    held = day.withColumn("quantity", F.sum("trade_quantity_change").over(w)).withColumn("non_trade_quantity_change", F.lit(0).cast("bigint"))
    bought = F.greatest(F.least(F.col("trade_quantity_change"), F.col("quantity")), F.lit(0))
    out["positions"] = held.select("portfolio_id", "instrument_id", "valuation_time", F.concat_ws("@", F.col("portfolio_id").cast("string"), "instrument_id", "valuation_time").alias("snapshot_id"), "quantity", (F.col("quantity") - bought).alias("sellable_quantity"), bought.alias("unsettled_quantity"), F.lit(0).cast("bigint").alias("frozen_quantity"), "trade_quantity_change", "non_trade_quantity_change")
    out["valuations"] = ends.select(F.col("account").alias("portfolio_id"), F.col("day").alias("valuation_time"), F.col("nav_units"))
    return out


def project_futures(simulated: DataFrame, multiplier: int, opening: int) -> dict[str, DataFrame]:
    """Rows of :func:`simulate_futures` as the six result tables, each product a portfolio.

    A fill or forced closing changes cash by its profit less its fee (a trade's change), a settlement
    by its profit (none of a trade). Positions are the running sum of fills; one that differs from the
    position that the session's last row states is an error.
    """
    from tidemark.operators.pit import guard

    c, one = F.col, F.concat_ws(":", "product", F.col("seq").cast("string"))
    base = simulated.withColumn("portfolio_id", c("product")).withColumn("order_id", one).withColumn("traded", c("kind").isin("fill", "forced"))
    done = base.where("traded").withColumn("fill_id", F.concat("order_id", F.lit(":f")))
    signed = F.when(c("side") == "buy", c("quantity")).otherwise(-c("quantity"))
    status = F.when(c("traded"), "filled").otherwise("rejected")
    out = {
        "orders": base.where("kind <> 'settle'").select("portfolio_id", "order_id", "session", c("contract").alias("instrument_id"), "side", c("quantity").alias("requested_quantity"), F.when(c("traded"), c("quantity")).otherwise(0).alias("filled_quantity"), status.alias("status"), F.when(~c("traded"), c("reason")).alias("terminal_reason")),
        "fills": done.select("portfolio_id", "fill_id", "order_id", "session", c("contract").alias("instrument_id"), "side", "quantity", c("price_units").alias("execution_price_units"), F.lit(multiplier).alias("contract_multiplier"), (c("price_units") * c("quantity") * multiplier).alias("notional_units"), "fee_units", F.coalesce("offset", F.lit("close")).alias("position_effect"), c("pnl_units").alias("realized_pnl_units")),
        "costs": done.select("portfolio_id", F.concat("order_id", F.lit(":c")).alias("cost_id"), "fill_id", "session", F.lit("transaction_fee").alias("cost_type"), c("fee_units").alias("amount_units")),
    }
    sum_if = lambda keep, x: F.sum(F.when(keep, x).otherwise(0))
    day = base.groupBy("portfolio_id", "session").agg(
        sum_if(c("traded"), c("pnl_units") - c("fee_units")).alias("trade_cash_change_units"), sum_if(c("kind") == "settle", c("pnl_units")).alias("non_trade_cash_change_units"),
        F.max_by("equity_units", "seq").alias("total_cash_units"), F.max_by(F.when(c("position") == 0, 0).otherwise(c("margin_units")), "seq").alias("margin_units"),
    ).withColumn("snapshot_id", F.concat_ws("@", "portfolio_id", c("session").cast("string")))
    out["cash"] = day.select("portfolio_id", "snapshot_id", c("session").alias("valuation_time"), F.lit(opening).cast("bigint").alias("opening_cash_units"), "trade_cash_change_units", "non_trade_cash_change_units", "total_cash_units", "margin_units", (c("total_cash_units") - c("margin_units")).alias("available_cash_units"))
    out["valuations"] = day.select("portfolio_id", "snapshot_id", c("session").alias("valuation_time"), c("total_cash_units").alias("nav_units"))
    held = base.where("kind <> 'reject'").groupBy("portfolio_id", c("contract").alias("instrument_id"), "session").agg(sum_if(c("traded"), signed).alias("trade_quantity_change"), F.max_by("position", "seq").alias("stated"))
    w = Window.partitionBy("portfolio_id", "instrument_id").orderBy("session").rowsBetween(Window.unboundedPreceding, 0)
    held = held.withColumn("quantity", F.sum("trade_quantity_change").over(w))
    held = held.where(guard((c("quantity") == c("stated")) | ((c("quantity") == 0) & (c("trade_quantity_change") != 0)), "the fills' positions are not those that are settled"))
    zero = F.lit(0).cast("bigint")
    out["positions"] = held.where("quantity <> 0 or trade_quantity_change <> 0").select("portfolio_id", "instrument_id", c("session").alias("valuation_time"), F.concat_ws("@", "portfolio_id", "instrument_id", c("session").cast("string")).alias("snapshot_id"), "quantity", c("quantity").alias("sellable_quantity"), zero.alias("unsettled_quantity"), zero.alias("frozen_quantity"), "trade_quantity_change", zero.alias("non_trade_quantity_change"))
    return out


def verify_result(tables: dict[str, DataFrame]) -> DataFrame:
    """All findings against a result; a sound one has none."""
    found = checks.fill_integrity(tables["orders"], tables["fills"])
    for part in (
        checks.order_closure(tables["orders"], tables["fills"]), checks.fee_closure(tables["fills"], tables["costs"]), checks.cash_conservation(tables["cash"]), checks.position_conservation(tables["positions"]),
    ):
        found = found.unionByName(part)
    return found


#: Gates of a result, and the findings that close each; fixed values.
GATES = {
    "data.pit": ("late_availability", "duplicate_key", "null_key"),
    "label.split": ("label_overlap", "empty_fold"),
    "search.holdout": ("holdout_opened_twice", "selection_on_test"),
    "statistics": ("incomplete_family", "missing_adjustment"),
    "financial.tradability": ("fill_reference", "fill_notional", "order_filled", "order_status", "fill_fee", "cost_reference", "cash_running", "position_running", "position_buckets", "valuation"),
}


def gates(findings: DataFrame, code: str = "check", not_applicable: Sequence[str] = ()) -> DataFrame:
    """Each gate with its status (pass, fail, not_applicable) and reason codes. An unknown finding is an error."""
    spark = findings.sparkSession
    known = spark.createDataFrame([(g, c, g in not_applicable) for g, codes in GATES.items() for c in codes], "gate string, code string, na boolean")
    seen = findings.groupBy(F.col(code).alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    both = known.join(seen, F.col("code") == F.col("__c"), "full_outer").where(F.when(F.col("gate").isNotNull(), F.lit(True)).otherwise(F.raise_error(F.lit("a finding belongs to no gate")).cast("boolean")))
    out = both.groupBy("gate").agg(F.array_sort(F.collect_set(F.when(F.col("__n") > 0, F.col("code")))).alias("codes"), F.every("na").alias("na"))
    status = F.when(F.size("codes") > 0, "fail").when(F.col("na"), "not_applicable").otherwise("pass")
    return out.select("gate", status.alias("status"), F.array_join("codes", ",").alias("reason_codes"))


# Futures data audit ----------------------------------------------------------------------------


def audit_futures(market: DataFrame, lifecycle: DataFrame, contracts: Sequence[str] | None, start, end, settlement: DataFrame | None = None, max_missing: float = 0.0, trading: bool = True) -> DataFrame:
    """Findings over daily futures data of named contracts (None: all) in a window: (issue, dataset, key, severity).

    ``market``: date, code, open, high, low, close, volume, open_interest; ``lifecycle``: code,
    listed, delisted; ``settlement``: date, code, settle_price (needed to trade).
    """
    if trading and settlement is None:
        raise ContractError("a trading audit needs settlements")
    c = F.col
    rows = market.where(c("date").between(F.lit(start), F.lit(end)))
    rows = rows if contracts is None else rows.where(c("code").isin(*contracts))
    key = F.concat_ws(":", c("date").cast("string"), c("code"))
    finding = lambda df, issue, dataset, k, severity="fail": df.select(F.lit(issue).alias("issue"), F.lit(dataset).alias("dataset"), k.alias("key"), F.lit(severity).alias("severity"))
    positive = lambda x: F.coalesce((c(x) > 0) & ~F.isnan(c(x).cast("double")), F.lit(False))
    not_negative = lambda x: F.coalesce((c(x) >= 0) & ~F.isnan(c(x).cast("double")), F.lit(False))
    envelope = positive("open") & positive("high") & positive("low") & positive("close") & F.coalesce((c("low") <= F.least("open", "close")) & (c("high") >= F.greatest("open", "close")), F.lit(False))
    prices = ["open", "high", "low", "close", "volume", "open_interest"]
    ratios = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c(p).isNull()).alias(p) for p in prices])
    shares = ratios.select(F.explode(F.array(*[F.struct(F.lit(p).alias("field"), F.try_divide(c(p), c("n")).alias("share")) for p in prices])).alias("x")).select("x.*")
    life = lifecycle.select(c("code").alias("l_code"), "listed", "delisted")
    alive = rows.join(life, c("code") == c("l_code"), "left")
    out = finding(rows.groupBy("date", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "duplicate_primary_key", "market", key)
    for part in (
        finding(rows.where(~(positive("close") & not_negative("volume") & not_negative("open_interest"))), "observation_market_invalid", "market", key),
        finding(rows.where(~envelope), "ohlc_invalid", "market", key, "fail" if trading else "warning"),
        finding(ratios.where("n = 0"), "market_empty", "market", F.lit("*")),
        finding(shares.where(c("share") > max_missing), "missing_ratio_exceeded", "market", c("field")),
        finding(alive.where("l_code is null").select("code").distinct(), "lifecycle_missing", "lifecycle", c("code")),
        finding(alive.where("date < listed or date > delisted"), "outside_lifecycle", "market", key),
    ):
        out = out.unionByName(part)
    if settlement is not None:
        s = settlement.select(c("date").alias("s_date"), c("code").alias("s_code"), "settle_price")
        match = (c("date") == c("s_date")) & (c("code") == c("s_code"))
        out = out.unionByName(finding(rows.join(s, match, "left_anti"), "settlement_missing", "settlement", key))
        out = out.unionByName(finding(s.where(~positive("settle_price")), "settlement_invalid", "settlement", F.concat_ws(":", c("s_date").cast("string"), c("s_code"))))
    return out


def audit_execution_prices(samples: DataFrame, tolerance_bps: float) -> DataFrame:
    """Local prices against official and vendor samples: the state of each check and the policy's verdict.

    Columns: key, local_price, official_price, vendor_price. An official price decides; a vendor's
    only confirms; without either a sample is unverified.
    """
    off = lambda p: F.abs(F.col("local_price") - F.col(p)) > F.abs(F.col(p)) * tolerance_bps / 10_000
    state = lambda p: F.when(F.col(p).isNull(), "not_available").when(off(p), "mismatch").otherwise("match")
    rows = samples.withColumn("official_state", state("official_price")).withColumn("vendor_state", state("vendor_price"))
    verdict = F.when(F.col("official_state") == "mismatch", "fail").when(F.col("official_state") == "match", "verified").when(F.col("vendor_state") == "match", "vendor_confirmed").when(F.col("vendor_state") == "mismatch", "warn").otherwise("unverified")
    return rows.withColumn("verdict", verdict)
