"""Structured Streaming forms of the operators that can run on unbounded input."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.simulation import MINUTE, MinuteAccount, MinutePolicy


def windowed_bars(ticks: DataFrame, interval: str, late: str, code: str = "code", time: str = "ts", price: str = "price", volume: str = "volume") -> DataFrame:
    """Bars of completed windows; events later than the watermark are dropped by it.

    A bar holds (start, end], so ticks are moved back by a microsecond before they meet Spark's
    [start, end) windows.
    """
    moved = ticks.withColumn("__t", F.col(time) - F.expr("interval 1 microsecond"))
    w = F.window("__t", interval)
    return (
        moved.withWatermark("__t", late)
        .groupBy(w.alias("__w"), code)
        .agg(
            F.min_by(price, time).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, time).alias("close"), F.sum(volume).alias("volume"), F.count(F.lit(1)).alias("ticks")
        )
        .select(F.col(code), F.col("__w.start").alias("bar_start"), F.col("__w.end").alias("dt"), "open", "high", "low", "close", "volume", "ticks")
    )


def first_events(events: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """Each event id once, remembered for as long as the watermark allows."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, gap: str, late: str, code: str = "code", time: str = "ts") -> DataFrame:
    """Activity sessions of each code, closed by a gap."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("__w"), code).agg(F.count(F.lit(1)).alias("events")).select(code, F.col("__w.start").alias("start"), F.col("__w.end").alias("end"), "events")


FEATURE = "code string, dt timestamp, lagged_return double, rolling_volatility double, bars_seen bigint"
STATE = "closes array<double>, last timestamp, seen bigint"


def rolling_features(bars: DataFrame, lookback: int, code: str = "code") -> DataFrame:
    """Lagged return and volatility of each code's last bars, state bounded by the lookback.

    Bars of a micro-batch are taken in order of time; a bar at or before the last one seen is late
    and left out, so that no row ever uses a later bar.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        closes, last, seen = state.get if state.exists else ([], None, 0)
        closes, rows = list(closes), []
        for bar in pd.concat(list(batches)).sort_values("dt").itertuples():
            if last is not None and bar.dt <= last:
                continue
            closes, last, seen = [*closes, float(bar.close)][-lookback:], bar.dt, seen + 1
            returns = pd.Series(closes).pct_change().dropna()
            rows.append((key[0], bar.dt, returns.iloc[-1] if len(returns) else None, returns.std(ddof=0) if len(returns) else None, seen))
        state.update((closes, last, seen))
        yield pd.DataFrame(rows, columns=["code", "dt", "lagged_return", "rolling_volatility", "bars_seen"])

    return bars.groupBy(code).applyInPandasWithState(step, FEATURE, STATE, "append", GroupStateTimeout.NoTimeout)


LABEL = "code string, dt timestamp, label_end timestamp, future_return double"
LABEL_STATE = "times array<timestamp>, closes array<double>"


def forward_labels(bars: DataFrame, horizon: int, code: str = "code") -> DataFrame:
    """A bar's return over the next ``horizon`` bars, sent when its exit bar arrives."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times, closes = state.get if state.exists else ([], [])
        times, closes, rows = list(times), list(closes), []
        for bar in pd.concat(list(batches)).sort_values("dt").itertuples():
            if times and bar.dt <= times[-1]:
                continue
            times.append(bar.dt)
            closes.append(float(bar.close))
            if len(times) > horizon:
                rows.append((key[0], times[0], bar.dt, closes[-1] / closes[0] - 1))
                times, closes = times[1:], closes[1:]
        state.update((times, closes))
        yield pd.DataFrame(rows, columns=["code", "dt", "label_end", "future_return"])

    return bars.groupBy(code).applyInPandasWithState(step, LABEL, LABEL_STATE, "append", GroupStateTimeout.NoTimeout)


class HacSums:
    """Sums for a mean with a Bartlett-kernel standard error, in one pass and memory of the lag's size."""

    def __init__(self, lag: int):
        self.lag, self.n, self.total = lag, 0, 0.0
        self.products = [0.0] * (lag + 1)  # of values k apart, uncentred
        self.head: list[float] = []
        self.tail: list[float] = []

    def add(self, value: float) -> None:
        self.products[0] += value * value
        for k, old in enumerate(reversed(self.tail), 1):
            self.products[k] += value * old
        if len(self.head) < self.lag:
            self.head.append(value)
        self.tail = [*self.tail, value][-self.lag :] if self.lag else []
        self.n, self.total = self.n + 1, self.total + value

    def estimate(self) -> tuple[float, float | None]:
        mean = self.total / self.n
        long_run = self.products[0] - self.n * mean * mean
        for k in range(1, min(self.lag, self.n - 1) + 1):
            # sum of (x_i - m)(x_(i-k) - m) over i: each side misses k values at one end
            sides = 2 * self.total - sum(self.head[:k]) - sum(self.tail[-k:])
            long_run += 2 * (1 - k / (self.lag + 1)) * (self.products[k] - mean * sides + (self.n - k) * mean * mean)
        return mean, math.sqrt(long_run) / self.n if long_run > 0 else None


HAC = "sample_size bigint, estimate double, standard_error double"


def _kept(start: Callable, step: Callable) -> Callable:
    """A stateful function whose state is one object, kept as bytes."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = pickle.loads(state.get[0]) if state.exists else start(key)  # noqa: S301  our own bytes
        yield step(key, held, pd.concat(list(batches)))
        state.update((pickle.dumps(held),))

    return run


def hac_means(values: DataFrame, key: str, order: str, value: str, lag: int) -> DataFrame:
    """After each micro-batch, every touched key's mean so far with its standard error; values come in order."""
    kind = values.schema[key].dataType.simpleString()

    def step(of: tuple, sums: HacSums, batch: pd.DataFrame) -> pd.DataFrame:
        for x in batch.sort_values(order)[value].dropna():
            sums.add(float(x))
        return pd.DataFrame([(of[0], sums.n, *(sums.estimate() if sums.n else (None, None)))], columns=[key, "sample_size", "estimate", "standard_error"])

    return values.groupBy(key).applyInPandasWithState(_kept(lambda of: HacSums(lag), step), f"`{key}` {kind}, {HAC}", "held binary", "append", GroupStateTimeout.NoTimeout)


def simulate_minutes(events: DataFrame, policy: MinutePolicy, opening: int) -> DataFrame:
    """Minute targets traded bar by bar as micro-batches bring them; see ``simulation.minute_events`` for the rows.

    The account is the state. Events of a batch are taken in their order; a session's ``close`` is sent
    when the next session begins.
    """
    order = ["time", "what", "code", "dt", "seq"]

    def step(of: tuple, account: MinuteAccount, batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in batch.sort_values(order).to_dict("records"):
            out += account.step({k: None if v is None or v is pd.NaT or v != v else v for k, v in row.items()})
        return pd.DataFrame(out, columns=[c.split()[0] for c in MINUTE.split(", ")], dtype=object)

    return events.groupBy("account").applyInPandasWithState(_kept(lambda of: MinuteAccount(int(of[0]), policy, opening), step), MINUTE, "held binary", "append", GroupStateTimeout.NoTimeout)


def start(flow: DataFrame, sink: str, checkpoint: str, mode: str = "append", trigger: dict | None = None):
    """Write a flow as Parquet exactly once: the sink's log and the checkpoint name what was committed."""
    return flow.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode(mode).trigger(**(trigger or {"availableNow": True})).start()
