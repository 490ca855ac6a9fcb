"""Queries over ordered series, cross-sections, ranks and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ranking, windows
from tidemark.registry import query as register
from tidemark.sources.tables import scan


def ticks(spark, d) -> DataFrame:
    return scan(spark, d, "events").select("event_id", "user_id", "ts", F.col("ts").cast("date").alias("day"), "event_type", "value")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


_W = "OVER (PARTITION BY user_id ORDER BY ts)"


@register("lag", f"SELECT event_id, LAG(value, 2) {_W} AS earlier FROM events")
def lag(spark: SparkSession, d: str) -> DataFrame:
    return windows.lag(ticks(spark, d), ["user_id"], ["ts"], "value", 2, "earlier").select("event_id", "earlier")


for _how, _sql in (("mean", "AVG"), ("sum", "SUM"), ("std", "STDDEV_SAMP"), ("min", "MIN"), ("max", "MAX")):
    _frame = "OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"

    def _rolling(spark, d, how=_how) -> DataFrame:
        return rounded(windows.rolling(ticks(spark, d), ["user_id"], ["ts"], "value", 5, how, "rolled", min_periods=3), "rolled").select("event_id", "rolled")

    register(f"rolling_{_how}", f"SELECT event_id, CASE WHEN COUNT(value) {_frame} >= 3 THEN ROUND({_sql}(value) {_frame}, 6) END AS rolled FROM events")(_rolling)


_D = "OVER (PARTITION BY CAST(ts AS DATE))"
_CS = {
    "rank": "ROUND((RANK() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY value) + (COUNT(*) OVER (PARTITION BY CAST(ts AS DATE), value) - 1) / 2.0) / COUNT(value) " + _D + ", 10)",
    "zscore": f"ROUND((value - AVG(value) {_D}) / STDDEV_SAMP(value) {_D}, 6)",
    "demean": f"ROUND(value - AVG(value) {_D}, 6)",
    "winsorize": f"ROUND(GREATEST(LEAST(value, QUANTILE_CONT(value, 0.95) {_D}), QUANTILE_CONT(value, 0.05) {_D}), 6)",
}
for _method, _sql in _CS.items():
    register(f"cs_{_method}", f"SELECT event_id, {_sql} AS score FROM events")(
        lambda spark, d, m=_method: rounded(windows.cross_section(ticks(spark, d), ["day"], "value", m, "score"), "score", digits=10 if m == "rank" else 6).select("event_id", "score")
    )

_DAILY = "SELECT user_id, CAST(ts AS DATE) AS day, ROUND(SUM(value), 6) AS total FROM events WHERE event_type = 'purchase' GROUP BY 1, 2"


def daily(spark, d) -> DataFrame:
    return ticks(spark, d).where("event_type = 'purchase'").groupBy("user_id", "day").agg(F.round(F.sum("value"), 6).alias("total"))


def calendar(spark, d) -> DataFrame:
    return ticks(spark, d).select("day").distinct()


_CAL = "SELECT DISTINCT CAST(ts AS DATE) AS day FROM events"


@register("calendar_align_exact", f"WITH t AS ({_DAILY}), c AS ({_CAL}), u AS (SELECT DISTINCT user_id FROM t) SELECT u.user_id, c.day, t.total FROM u CROSS JOIN c LEFT JOIN t ON t.user_id = u.user_id AND t.day = c.day", dates=("day",))
def calendar_align_exact(spark: SparkSession, d: str) -> DataFrame:
    return windows.calendar_align(daily(spark, d), calendar(spark, d), ["user_id"], "day", "total", "exact")


@register(
    "calendar_align_backward",
    f"WITH t AS ({_DAILY}), c AS ({_CAL}), u AS (SELECT user_id, MIN(day) AS first FROM t GROUP BY 1), g AS (SELECT user_id, day FROM u JOIN c ON c.day >= u.first) SELECT g.user_id, g.day, t.total FROM g ASOF JOIN t ON t.user_id = g.user_id AND g.day >= t.day",
    dates=("day",),
)
def calendar_align_backward(spark: SparkSession, d: str) -> DataFrame:
    return windows.calendar_align(daily(spark, d), calendar(spark, d), ["user_id"], "day", "total", "backward")


@register("label_forward", f"SELECT event_id, ROUND(LEAD(value, 3) {_W} / value - 1, 6) AS label, LEAD(ts, 3) {_W} AS label_available FROM events")
def label_forward(spark: SparkSession, d: str) -> DataFrame:
    return rounded(windows.forward_label(ticks(spark, d), ["user_id"], ["ts"], "value", 3, "ts"), "label").select("event_id", "label", "label_available")


@register(
    "event_window",
    f"""WITH t AS ({_DAILY}), c AS (SELECT day, ROW_NUMBER() OVER (ORDER BY day) AS n FROM ({_CAL})),
e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'signup'),
o AS (SELECT e.event_id, e.user_id, c.n + r.r AS n, r.r AS relative_session FROM e JOIN c USING (day) CROSS JOIN (SELECT UNNEST([-2, -1, 0, 1, 2]) AS r) r)
SELECT o.event_id, o.user_id, CAST(o.relative_session AS BIGINT) AS relative_session, c.day, t.total FROM o JOIN c ON c.n = o.n JOIN t ON t.user_id = o.user_id AND t.day = c.day""",
    dates=("day",),
)
def event_window(spark: SparkSession, d: str) -> DataFrame:
    signups = ticks(spark, d).where("event_type = 'signup'").select("event_id", "user_id", F.col("day").alias("anchor"))
    out = windows.event_window(signups, daily(spark, d), calendar(spark, d), "user_id", "anchor", "day", 2, 2)
    return out.select("event_id", "user_id", F.col("relative_session").cast("bigint").alias("relative_session"), "day", "total")


@register(
    "gap_islands",
    "WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), g AS (SELECT user_id, day, CASE WHEN date_diff('day', LAG(day) OVER w, day) = 1 THEN 0 ELSE 1 END AS gap FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day)) SELECT user_id, day, CAST(SUM(gap) OVER (PARTITION BY user_id ORDER BY day) AS BIGINT) AS island FROM g",
    dates=("day",),
)
def gap_islands(spark: SparkSession, d: str) -> DataFrame:
    days = ticks(spark, d).select("user_id", "day", F.col("day").cast("timestamp_ntz").alias("at")).distinct()
    return windows.gap_islands(days, ["user_id"], "at", 86_400).select("user_id", "day", "island")


_RUN = "OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)"


@register("drawdown", f"SELECT event_id, ROUND(value / MAX(value) {_RUN} - 1, 6) AS drawdown FROM events")
def drawdown(spark: SparkSession, d: str) -> DataFrame:
    return rounded(windows.drawdown(ticks(spark, d), ["user_id"], ["ts"], "value"), "drawdown").select("event_id", "drawdown")


@register("running_sum", f"SELECT event_id, CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) {_RUN} AS BIGINT) AS units FROM events")
def running_sum(spark: SparkSession, d: str) -> DataFrame:
    units = ticks(spark, d).withColumn("u", F.round(F.col("value") * 100).cast("bigint"))
    return windows.running_sum(units, ["user_id"], ["ts"], "u", "units").select("event_id", "units")


# Ranks -----------------------------------------------------------------------------------------

_POS = "ROW_NUMBER() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY value DESC, event_id)"


@register("score_order", f"SELECT event_id, {_POS} AS position FROM events WHERE value IS NOT NULL")
def score_order(spark: SparkSession, d: str) -> DataFrame:
    return ranking.score_order(ticks(spark, d), ["day"], "value", "event_id").select("event_id", "position")


@register("top_n", f"SELECT CAST(ts AS DATE) AS day, event_id, value, {_POS} AS position FROM events QUALIFY position <= 5", dates=("day",))
def top_n(spark: SparkSession, d: str) -> DataFrame:
    return ranking.top_n(ticks(spark, d), ["day"], "value", "event_id", 5).select("day", "event_id", "value", "position")


@register("quantile_buckets", f"SELECT event_id, 10 - CAST(FLOOR(({_POS} - 1) * 10 / COUNT(*) OVER (PARTITION BY CAST(ts AS DATE))) AS INTEGER) AS bucket FROM events")
def quantile_buckets(spark: SparkSession, d: str) -> DataFrame:
    return ranking.quantile_buckets(ticks(spark, d), ["day"], "value", "event_id", 10).select("event_id", "bucket")


_SCORES = "SELECT user_id AS candidate, ROUND(AVG(value), 6) AS score FROM events GROUP BY 1"


def scores(spark, d) -> DataFrame:
    return ticks(spark, d).groupBy(F.col("user_id").alias("candidate")).agg(F.round(F.avg("value"), 6).alias("score"))


@register("validation_winner", f"SELECT candidate, score FROM ({_SCORES}) ORDER BY score DESC, candidate LIMIT 1")
def validation_winner(spark: SparkSession, d: str) -> DataFrame:
    return ranking.select_candidate(scores(spark, d).withColumn("stage", F.lit("validation")), "score", "candidate", "maximize", "stage").select("candidate", "score")


@register("competition_rank", "SELECT event_type, day, n, RANK() OVER (PARTITION BY event_type ORDER BY n DESC) AS rank, n - MAX(n) OVER (PARTITION BY event_type) AS difference_from_best FROM (SELECT event_type, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1, 2)", dates=("day",))
def competition_rank(spark: SparkSession, d: str) -> DataFrame:
    counts = ticks(spark, d).groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("n"))
    return ranking.competition_rank(counts, "n", group=["event_type"])


_POSITIONS = "SELECT o_custkey AS account, l_partkey AS code, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END) AS BIGINT) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"


def positions(spark, d) -> DataFrame:
    rows = scan(spark, d, "lineitem").join(scan(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return rows.groupBy(F.col("o_custkey").alias("account"), F.col("l_partkey").alias("code")).agg(F.sum(signed).cast("bigint").alias("quantity"))


@register(
    "liquidation_order",
    f"SELECT account, code, ROW_NUMBER() OVER (PARTITION BY account ORDER BY CASE WHEN p_size <= 10 THEN p_size END NULLS LAST, ABS(quantity) * p_retailprice DESC, code) AS liquidation_position FROM ({_POSITIONS}) JOIN part ON p_partkey = code WHERE quantity <> 0",
)
def liquidation_order(spark: SparkSession, d: str) -> DataFrame:
    parts = scan(spark, d, "part").select("p_partkey", "p_retailprice", F.when(F.col("p_size") <= 10, F.col("p_size")).alias("priority"))
    held = positions(spark, d).join(parts, F.col("p_partkey") == F.col("code"))
    return ranking.liquidation_order(held, ["account"], "code", "quantity", "p_retailprice", "priority").select("account", "code", "liquidation_position")


@register(
    "rebalance_order",
    f"""WITH p AS ({_POSITIONS}), t AS (SELECT account, code, CAST(FLOOR(quantity / 2.0) AS BIGINT) AS quantity FROM p WHERE code % 3 <> 0 UNION ALL SELECT account, code + 100000, 10 FROM p WHERE code % 5 = 0),
d AS (SELECT account, code, COALESCE(t.quantity, 0) - COALESCE(p.quantity, 0) AS delta FROM p FULL JOIN t USING (account, code))
SELECT account, code, CAST(delta AS BIGINT) AS delta, CASE WHEN delta < 0 THEN 'sell' ELSE 'buy' END AS side, CAST(ABS(delta) AS BIGINT) AS quantity, ROW_NUMBER() OVER (PARTITION BY account ORDER BY delta >= 0, code) AS order_position FROM d WHERE delta <> 0""",
)
def rebalance_order(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.functions.scalars import floor_ratio

    held = positions(spark, d)
    half = held.where("code % 3 <> 0").withColumn("quantity", floor_ratio(F.col("quantity"), 2))
    new = held.where("code % 5 = 0").select("account", (F.col("code") + 100_000).alias("code"), F.lit(10).cast("bigint").alias("quantity"))
    return ranking.rebalance(held, half.unionByName(new), ["account"], "code")


@register("event_normalise", "SELECT event_id, user_id, ts, value FROM events")
def event_normalise(spark: SparkSession, d: str) -> DataFrame:
    rows = ticks(spark, d).select("event_id", "user_id", "ts", "value")
    return ranking.normalise_events(rows.unionAll(rows.where("event_id % 3 = 0")), "event_id", ["ts"])


@register("sequence_gaps", "SELECT user_id, event_id, previous_sequence FROM (SELECT user_id, event_id, LAG(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_sequence FROM events) WHERE previous_sequence + 1 < event_id")
def sequence_gaps(spark: SparkSession, d: str) -> DataFrame:
    return ranking.sequence_gaps(ticks(spark, d).select("user_id", "event_id"), "user_id", "event_id")
