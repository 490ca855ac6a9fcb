"""Queries over statistics, validation splits, models and causal time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import causal, modeling, ranking, statistics, validation
from tidemark.plans.series import rounded
from tidemark.registry import query as register
from tidemark.sources.tables import scan

#: Daily returns of nations: relative changes of the value ordered each day by customers of a nation.
_RETURNS = """SELECT nation, day, total / LAG(total) OVER (PARTITION BY nation ORDER BY day) - 1 AS r, total FROM
 (SELECT c_nationkey AS nation, date_trunc('quarter', o_orderdate) AS day, ROUND(SUM(o_totalprice), 2) AS total FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)"""


def returns(spark: SparkSession, d: str) -> DataFrame:
    quarter = F.make_timestamp_ntz(F.year("o_orderdate"), (F.quarter("o_orderdate") * 3 - 2).cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    rows = scan(spark, d, "orders").join(scan(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    totals = rows.groupBy(F.col("c_nationkey").alias("nation"), quarter.alias("day")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    w = Window.partitionBy("nation").orderBy("day")
    return totals.select("nation", "day", (F.col("total") / F.lag("total").over(w) - 1).alias("r"), "total")


def _clean(spark, d) -> DataFrame:
    return returns(spark, d).where("r is not null")


_CLEAN = f"SELECT * FROM ({_RETURNS}) WHERE r IS NOT NULL"


@register(
    "hac_mean",
    f"""WITH c AS (SELECT nation, day, r, r - AVG(r) OVER (PARTITION BY nation) AS x FROM ({_CLEAN})), p AS (SELECT *, x * LAG(x, 1) OVER w AS p1, x * LAG(x, 2) OVER w AS p2 FROM c WINDOW w AS (PARTITION BY nation ORDER BY day)),
g AS (SELECT nation, COUNT(*) AS n, AVG(r) AS m, SUM(x * x) AS g0, SUM(p1) AS g1, SUM(p2) AS g2 FROM p GROUP BY 1), v AS (SELECT *, GREATEST((g0 + 2 * (2.0 / 3) * g1 + 2 * (1.0 / 3) * g2) / n / n, 0) AS v FROM g)
SELECT nation, n AS sample_size, ROUND(m, 8) AS estimate, ROUND(SQRT(v), 8) AS standard_error, ROUND(CASE WHEN v > 0 THEN GREATEST(1, LEAST(n, g0 / n / v)) END, 6) AS effective_sample_size FROM v""",
)
def hac_mean(spark: SparkSession, d: str) -> DataFrame:
    out = statistics.hac_mean(_clean(spark, d), ["nation"], ["day"], "r", 2)
    return rounded(rounded(out, "estimate", "standard_error", digits=8), "effective_sample_size").drop("z_value")


@register(
    "overlap_lag",
    "WITH i AS (SELECT user_id, ts, ts + to_hours(CAST(12 + event_id % 60 AS BIGINT)) AS te FROM events) SELECT user_id, MAX(n) AS overlap_lag FROM (SELECT a.user_id, a.ts, COUNT(b.ts) AS n FROM i a LEFT JOIN i b ON b.user_id = a.user_id AND b.ts > a.ts AND b.ts < a.te GROUP BY 1, 2) GROUP BY 1",
)
def overlap_lag(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "events").select("user_id", "ts", (F.col("ts") + F.make_dt_interval(F.lit(0), (F.lit(12) + F.col("event_id") % 60).cast("int"))).alias("te"))
    return statistics.overlap_lag(rows, ["user_id"], "ts", "te")


def _cluster_sql(keys: str) -> str:
    return f"SELECT COUNT(*) AS g, SUM(s * s) AS ss FROM (SELECT SUM(x) AS s FROM c GROUP BY {keys})"


@register(
    "cluster_mean_two_way",
    f"""WITH c AS (SELECT nation, day, r, r - AVG(r) OVER () AS x FROM ({_CLEAN})), n AS (SELECT COUNT(*) AS n, AVG(r) AS m FROM c), a AS ({_cluster_sql("nation")}), b AS ({_cluster_sql("day")}), i AS ({_cluster_sql("nation, day")})
SELECT n.n AS sample_size, ROUND(n.m, 8) AS estimate, a.g AS first_count, b.g AS second_count, i.g AS both_count, ROUND(SQRT(a.g / (a.g - 1.0) * a.ss / n.n / n.n + b.g / (b.g - 1.0) * b.ss / n.n / n.n - i.g / (i.g - 1.0) * i.ss / n.n / n.n), 8) AS standard_error FROM n, a, b, i""",
)
def cluster_mean_two_way(spark: SparkSession, d: str) -> DataFrame:
    out = statistics.cluster_mean(_clean(spark, d).withColumn("all", F.lit(1)), ["all"], "r", "nation", "day").drop("all")
    return rounded(out, "estimate", "standard_error", digits=8)


@register(
    "event_inference",
    f"""WITH c AS (SELECT nation, day, r, (nation * 7 + year(day)) % 5 AS k FROM ({_CLEAN})), x AS (SELECT *, r - AVG(r) OVER (PARTITION BY k) AS x FROM c), n AS (SELECT k, COUNT(*) AS n, AVG(r) AS m FROM x GROUP BY 1),
f AS (SELECT k, COUNT(*) AS g, SUM(s * s) AS ss FROM (SELECT k, SUM(x) AS s FROM x GROUP BY k, nation) GROUP BY 1), t AS (SELECT k, COUNT(*) AS g, SUM(s * s) AS ss FROM (SELECT k, SUM(x) AS s FROM x GROUP BY k, day) GROUP BY 1), i AS (SELECT k, COUNT(*) AS g, SUM(s * s) AS ss FROM (SELECT k, SUM(x) AS s FROM x GROUP BY k, nation, day) GROUP BY 1),
v AS (SELECT n.k, n, m, f.g / (f.g - 1.0) * f.ss / n / n + t.g / (t.g - 1.0) * t.ss / n / n - i.g / (i.g - 1.0) * i.ss / n / n AS v FROM n JOIN f USING (k) JOIN t USING (k) JOIN i USING (k))
SELECT k AS relative_session, n AS sample_size, ROUND(m, 8) AS estimate, ROUND(SUM(m) OVER (ORDER BY k), 8) AS cumulative, ROUND(CASE WHEN v > 0 THEN SQRT(v) END, 8) AS standard_error FROM v""",
)
def event_inference(spark: SparkSession, d: str) -> DataFrame:
    rows = _clean(spark, d).withColumn("relative_session", (F.col("nation") * 7 + F.year("day")) % 5)
    out = statistics.event_inference(rows, "relative_session", "r", "nation", "day")
    return rounded(out, "estimate", "cumulative", "standard_error", digits=8).select("relative_session", "sample_size", "estimate", "cumulative", "standard_error")


# A raw p-value for each user: a share, so that both engines have the same numbers
_P = "SELECT user_id, user_id % 3 AS family, ROUND(CAST(SUM(event_id % 97) AS DOUBLE) % 1000 / 20000, 6) AS p FROM events GROUP BY 1"


def p_values(spark: SparkSession, d: str) -> DataFrame:
    return scan(spark, d, "events").groupBy("user_id").agg(F.round(F.sum(F.col("event_id") % 97).cast("double") % 1000 / 20000, 6).alias("p")).withColumn("family", F.col("user_id") % 3)


_RANKED = f"SELECT user_id, family, p, COUNT(*) OVER (PARTITION BY family) AS n, ROW_NUMBER() OVER (PARTITION BY family ORDER BY p, user_id) AS k FROM ({_P})"
_ADJUST = {
    "bonferroni": "p * n",
    "holm": "MAX(p * (n - k + 1)) OVER (PARTITION BY family ORDER BY k)",
    "benjamini_hochberg": "MIN(p * n / k) OVER (PARTITION BY family ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
    "benjamini_yekutieli": "MIN(p * n * h / k) OVER (PARTITION BY family ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
}
for _method, _sql in _ADJUST.items():
    register(f"adjust_p_{_method}", f"WITH r AS (SELECT *, (SELECT SUM(1.0 / i) FROM range(1, n + 1) t(i)) AS h FROM ({_RANKED})) SELECT user_id, ROUND(LEAST(1.0, {_sql}), 8) AS adjusted_p FROM r")(
        lambda spark, d, m=_method: rounded(statistics.adjust_p(p_values(spark, d), ["family"], "p", "user_id", m, independent=True), "adjusted_p", digits=8).select("user_id", "adjusted_p")
    )

_MOMENTS = f"""WITH z AS (SELECT nation, r, (r - AVG(r) OVER w) / STDDEV_SAMP(r) OVER w AS z FROM ({_CLEAN}) WINDOW w AS (PARTITION BY nation)), m AS (SELECT nation, COUNT(*) AS n, AVG(r) / STDDEV_SAMP(r) AS s, AVG(z * z * z) AS k3, AVG(z * z * z * z) AS k4 FROM z GROUP BY 1)"""


@register("sharpe_z", f"{_MOMENTS} SELECT nation, n AS sample_size, ROUND(s, 8) AS sharpe, ROUND(k3, 8) AS skew, ROUND(k4, 8) AS kurtosis, ROUND(s * SQRT(n - 1) / SQRT(1 - k3 * s + (k4 - 1) / 4 * s * s), 7) AS z_value FROM m")
def sharpe_z(spark: SparkSession, d: str) -> DataFrame:
    out = statistics.psr_z(statistics.sharpe_moments(_clean(spark, d), ["nation"], "r"))
    return rounded(rounded(out, "sharpe", "skew", "kurtosis", digits=8), "z_value", digits=7)


def _cdf_sql(z: str) -> str:
    """The normal distribution function as its series z + z^3/3 + z^5/15 + ..., good for |z| below 8."""
    term = "exp((2 * k + 1) * ln(abs({z})) - (k + 1) * ln(2) - lgamma(k + 1.5) + 0.5 * ln(pi()))".format(z=z)
    return f"(CASE WHEN {z} = 0 THEN 0.5 ELSE 0.5 + sign({z}) * exp(-0.5 * {z} * {z}) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 150), lambda k: {term})) END)"


@register("probabilistic_sharpe", f"{_MOMENTS}, v AS (SELECT nation, s, s * SQRT(n - 1) / SQRT(1 - k3 * s + (k4 - 1) / 4 * s * s) AS z FROM m) SELECT nation, ROUND(s, 8) AS sharpe, ROUND({_cdf_sql('z')}, 7) AS probability FROM v")
def probabilistic_sharpe(spark: SparkSession, d: str) -> DataFrame:
    out = statistics.probabilistic_sharpe(_clean(spark, d), ["nation"], "r").select("nation", "sharpe", "probability")
    return rounded(rounded(out, "sharpe", digits=8), "probability", digits=7)


@register(
    "effective_trials",
    f"WITH c AS (SELECT a.nation AS x, b.nation AS y, CORR(a.r, b.r) AS rho FROM ({_CLEAN}) a JOIN ({_CLEAN}) b USING (day) GROUP BY 1, 2) SELECT SQRT(CAST(COUNT(*) AS DOUBLE)) AS trials, ROUND(GREATEST(1, LEAST(SQRT(COUNT(*)), COUNT(*) / SUM(rho * rho))), 6) AS effective_trials FROM c",
)
def effective_trials(spark: SparkSession, d: str) -> DataFrame:
    return rounded(statistics.effective_trials(_clean(spark, d), "day", "nation", "r"), "effective_trials")


#: Normal quantiles by Newton steps from 0 on the series, then the expected maximum of as many idle trials.
_DEFLATED = f"""WITH RECURSIVE {_MOMENTS.removeprefix('WITH ')}, c AS (SELECT a.nation AS x, b.nation AS y, CORR(a.r, b.r) AS rho FROM ({_CLEAN}) a JOIN ({_CLEAN}) b USING (day) GROUP BY 1, 2), t AS (SELECT GREATEST(1, LEAST(SQRT(COUNT(*)), COUNT(*) / SUM(rho * rho))) AS t FROM c),
p(w, p) AS (SELECT 1, 1 - 1 / t FROM t UNION ALL SELECT 2, 1 - 1 / (t * exp(1)) FROM t), q(w, p, k, x) AS (SELECT w, p, 0, CAST(0 AS DOUBLE) FROM p UNION ALL SELECT w, p, k + 1, x - ({_cdf_sql('x')} - p) / (exp(-0.5 * x * x) / sqrt(2 * pi())) FROM q WHERE k < 40),
bb AS (SELECT (SELECT STDDEV_SAMP(s) FROM m) * ((1 - 0.5772156649015329) * (SELECT x FROM q WHERE w = 1 AND k = 40) + 0.5772156649015329 * (SELECT x FROM q WHERE w = 2 AND k = 40)) AS b), v AS (SELECT s, b, t, (s - b) * SQRT(n - 1) / SQRT(1 - k3 * s + (k4 - 1) / 4 * s * s) AS z FROM m, bb, t WHERE nation = 3)
SELECT ROUND(s, 7) AS sharpe, ROUND(b, 7) AS benchmark, ROUND(t, 6) AS effective_trials, ROUND({_cdf_sql('z')}, 6) AS probability FROM v"""


@register("deflated_sharpe", _DEFLATED)
def deflated_sharpe(spark: SparkSession, d: str) -> DataFrame:
    rows = _clean(spark, d).withColumn("nation", F.col("nation").cast("string"))
    out = spark.createDataFrame([statistics.deflated_sharpe(rows, "day", "nation", "r", "3")], "sharpe double, benchmark double, effective_trials double, probability double")
    return rounded(rounded(out, "sharpe", "benchmark", digits=7), "effective_trials", "probability")


_SPLITS = f"SELECT nation, split, ROUND(AVG(r), 8) AS score FROM ({_CLEAN}) JOIN (SELECT day, NTILE(6) OVER (ORDER BY day) AS split FROM (SELECT DISTINCT day FROM ({_CLEAN}))) USING (day) GROUP BY 1, 2"


@register(
    "overfitting_probability",
    f"""WITH s AS ({_SPLITS}), y AS (SELECT DISTINCT split FROM s), h AS (SELECT ROW_NUMBER() OVER () AS combination, a.split AS a, b.split AS b, c.split AS c FROM y a JOIN y b ON a.split < b.split JOIN y c ON b.split < c.split),
m AS (SELECT combination, nation, AVG(CASE WHEN split IN (a, b, c) THEN score END) AS i, AVG(CASE WHEN split NOT IN (a, b, c) THEN score END) AS o FROM h CROSS JOIN s GROUP BY 1, 2),
r AS (SELECT combination, ROW_NUMBER() OVER (PARTITION BY combination ORDER BY i DESC, nation) AS best, ROW_NUMBER() OVER (PARTITION BY combination ORDER BY o, nation) AS rank, COUNT(*) OVER (PARTITION BY combination) AS n FROM m)
SELECT AVG(CASE WHEN (rank - 0.5) / n <= 0.5 THEN 1.0 ELSE 0.0 END) AS probability, COUNT(*) AS combinations FROM r WHERE best = 1""",
)
def overfitting_probability(spark: SparkSession, d: str) -> DataFrame:
    rows = _clean(spark, d)
    splits = rows.select("day").distinct().withColumn("split", F.ntile(6).over(Window.orderBy("day")))  # one row a quarter
    scores = rows.join(splits, "day").groupBy("nation", "split").agg(F.round(F.avg("r"), 8).alias("score"))
    return statistics.overfitting_probability(scores, "split", "nation", "score")


@register("reality_check_white")
def reality_check_white(spark: SparkSession, d: str) -> DataFrame:
    return statistics.reality_check(_clean(spark, d).withColumn("nation", F.col("nation").cast("string")), "day", "nation", "r", "white", replications=300)


@register("reality_check_spa")
def reality_check_spa(spark: SparkSession, d: str) -> DataFrame:
    return statistics.reality_check(_clean(spark, d).withColumn("nation", F.col("nation").cast("string")), "day", "nation", "r", "spa", replications=300)


@register(
    "portfolio_metrics",
    f"""WITH p AS (SELECT *, total / MAX(total) OVER (PARTITION BY nation ORDER BY day ROWS UNBOUNDED PRECEDING) - 1 AS dd FROM ({_RETURNS}))
SELECT nation, ROUND(PRODUCT(1 + r) - 1, 6) AS total_return, ROUND(MIN(dd), 6) AS max_drawdown, ROUND(STDDEV_POP(r) * SQRT(4), 6) AS annualized_volatility, ROUND(AVG(r) / STDDEV_POP(r) * SQRT(4), 6) AS sharpe, ROUND(AVG(ABS(r)), 6) AS turnover_mean FROM p GROUP BY 1""",
)
def portfolio_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = returns(spark, d).withColumn("turnover", F.abs("r"))
    out = statistics.portfolio_metrics(rows, ["nation"], ["day"], "r", "total", "turnover", 4)
    return rounded(out, *out.columns[1:])


_STATS = """SELECT nation, COUNT(*) AS count, ROUND(AVG(r), 8) AS mean, COUNT(*) FILTER (r > 0) AS positive_count, COUNT(*) FILTER (r < 0) AS negative_count, COUNT(*) FILTER (r = 0) AS zero_count, ROUND(MAX(r), 8) AS best_value, arg_max(day, r) AS best_date, ROUND(MIN(r), 8) AS worst_value, arg_min(day, r) AS worst_date,
 ROUND(arg_min(r, day), 8) AS first_value, ROUND(arg_max(r, day), 8) AS last_value"""


@register("result_statistics_level", f"{_STATS}, ROUND(arg_max(r, day) - arg_min(r, day), 8) AS absolute_change FROM ({_CLEAN}) GROUP BY 1")
def result_statistics_level(spark: SparkSession, d: str) -> DataFrame:
    out = statistics.result_statistics(_clean(spark, d), ["nation"], "day", "r", "level")
    return rounded(out, "mean", "best_value", "worst_value", "first_value", "last_value", "absolute_change", digits=8)


def _path_sql(grown: str) -> str:
    return f"""WITH n AS (SELECT *, EXP(SUM({grown}) OVER (PARTITION BY nation ORDER BY day ROWS UNBOUNDED PRECEDING)) AS net FROM ({_CLEAN})), q AS (SELECT *, net / GREATEST(1, MAX(net) OVER (PARTITION BY nation ORDER BY day ROWS UNBOUNDED PRECEDING)) - 1 AS dd FROM n)
SELECT nation, COUNT(*) AS count, ROUND(LEAST(MIN(dd), 0), 6) AS max_drawdown, ROUND(arg_max(net, day) - 1, 6) AS compounded_return, ROUND(POW(arg_max(net, day), 4.0 / COUNT(*)) - 1, 6) AS geometric_annualized_return FROM q GROUP BY 1"""


def _path(spark, d, semantics) -> DataFrame:
    rows = _clean(spark, d)
    out = statistics.result_statistics(rows, ["nation"], "day", "r", semantics, 4)
    return rounded(out, "max_drawdown", "compounded_return", "geometric_annualized_return").select("nation", "count", "max_drawdown", "compounded_return", "geometric_annualized_return")


register("result_statistics_simple", _path_sql("LN(1 + r)"))(lambda spark, d: _path(spark, d, "simple_return"))
register("result_statistics_log", _path_sql("r"))(lambda spark, d: _path(spark, d, "log_return"))


@register(
    "calendar_years",
    "WITH s AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders), y AS (SELECT UNNEST(range(year(lo), year(hi) + 1)) AS year, lo, hi FROM s) SELECT y.year, lo <= make_date(y.year, 1, 1) AND hi >= make_date(y.year, 12, 31) AS complete_year, COUNT(o_orderkey) AS count, ROUND(AVG(o_totalprice), 4) AS mean, COUNT(*) FILTER (o_totalprice > 0) AS positive_count FROM y LEFT JOIN orders ON year(o_orderdate) = y.year GROUP BY 1, 2",
)
def calendar_years(spark: SparkSession, d: str) -> DataFrame:
    return rounded(statistics.calendar_years(scan(spark, d, "orders"), "o_orderdate", "o_totalprice"), "mean", digits=4)


@register("comparable_runs", "SELECT FALSE AS comparable, 'c_nationkey_differs,c_mktsegment_differs' AS reason_codes")
def comparable_runs(spark: SparkSession, d: str) -> DataFrame:
    runs = scan(spark, d, "customer").withColumn("spec", F.lit("v1"))
    return statistics.comparable(runs, ["spec", "c_nationkey", "c_mktsegment"])


# Validation ------------------------------------------------------------------------------------

_SAMPLES = "SELECT o_orderkey AS sample_id, o_orderdate AS t, o_orderdate + INTERVAL 1 DAY AS ls, o_orderdate + to_days(CAST(2 + o_orderkey % 9 AS INTEGER)) AS le FROM orders"
_SESSIONS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS session FROM orders"


def samples(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("o_orderdate")
    end = t + F.make_dt_interval((F.lit(2) + F.col("o_orderkey") % 9).cast("int"))
    return scan(spark, d, "orders").select(F.col("o_orderkey").alias("sample_id"), t.alias("observation_time"), t.alias("decision_time"), (t + F.expr("interval 1 day")).alias("label_start"), end.alias("label_end"), end.alias("label_available"))


def sessions(spark: SparkSession, d: str) -> DataFrame:
    return scan(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("session")).distinct()


@register(
    "purged_kfold",
    f"""WITH s AS ({_SAMPLES}), c AS (SELECT session, ROW_NUMBER() OVER (ORDER BY session) AS n FROM ({_SESSIONS})), k AS (SELECT *, NTILE(4) OVER (ORDER BY t, sample_id) AS fold FROM s),
b AS (SELECT fold, MIN(t) AS a, MAX(t) AS z, (SELECT MAX(n) FROM c WHERE session <= CAST(MAX(k.t) AS DATE)) AS zn FROM k GROUP BY 1)
SELECT b.fold, k.sample_id, CASE WHEN k.fold = b.fold THEN 'validation' WHEN k.ls <= b.z AND k.le >= b.a THEN 'purged' WHEN c.n > b.zn AND c.n <= b.zn + 3 THEN 'embargoed' ELSE 'train' END AS role FROM k CROSS JOIN b JOIN c ON c.session = CAST(k.t AS DATE)""",
)
def purged_kfold(spark: SparkSession, d: str) -> DataFrame:
    return validation.purged_kfold(samples(spark, d), sessions(spark, d), 4, 3)


def _walk_sql(first: str) -> str:
    return f"""WITH s AS ({_SAMPLES}), c AS (SELECT session, ROW_NUMBER() OVER (ORDER BY session) AS n FROM ({_SESSIONS})), o AS (SELECT UNNEST(range(0, 4000, 250)) AS o), f AS (SELECT ROW_NUMBER() OVER (ORDER BY o) AS fold, {first} AS a, o + 500 AS b, o + 620 AS c, o + 625 AS d, o + 685 AS e FROM o WHERE o + 685 <= (SELECT MAX(n) FROM c)),
r AS (SELECT f.fold, s.sample_id, s.t, s.le, CASE WHEN n <= b THEN 'train' WHEN n <= f.c THEN 'validation' WHEN n <= d THEN 'embargoed' ELSE 'test' END AS part FROM s JOIN c ON c.session = CAST(s.t AS DATE) JOIN f ON n BETWEEN a AND e),
x AS (SELECT *, MIN(CASE WHEN part = 'validation' THEN t END) OVER (PARTITION BY fold) AS v, MIN(CASE WHEN part = 'test' THEN t END) OVER (PARTITION BY fold) AS w FROM r)
SELECT fold, sample_id, CASE WHEN part = 'train' AND NOT (le < v AND le <= v) THEN 'purged' WHEN part = 'validation' AND NOT (le < w AND le <= w) THEN 'purged' ELSE part END AS role FROM x"""


register("walk_forward_expanding", _walk_sql("1"))(lambda spark, d: validation.walk_forward(samples(spark, d), sessions(spark, d), 500, 120, 60, 250, 5, True))
register("walk_forward_rolling", _walk_sql("o + 1"))(lambda spark, d: validation.walk_forward(samples(spark, d), sessions(spark, d), 500, 120, 60, 250, 5, False))


_NESTED = f"""WITH w AS ({_walk_sql("1")}), s AS ({_SAMPLES}), c AS (SELECT session, ROW_NUMBER() OVER (ORDER BY session) AS n FROM ({_SESSIONS})), k AS (SELECT w.fold AS outer_fold, s.*, NTILE(3) OVER (PARTITION BY w.fold ORDER BY t, s.sample_id) AS fold FROM w JOIN s USING (sample_id) WHERE role = 'train'),
b AS (SELECT outer_fold, fold, MIN(t) AS a, MAX(t) AS z, (SELECT MAX(n) FROM c WHERE session <= CAST(MAX(k.t) AS DATE)) AS zn FROM k GROUP BY 1, 2)
SELECT k.outer_fold, b.fold AS inner_fold, CASE WHEN k.fold = b.fold THEN 'validation' WHEN k.ls <= b.z AND k.le >= b.a THEN 'purged' WHEN c.n > b.zn AND c.n <= b.zn + 1 THEN 'embargoed' ELSE 'train' END AS role, COUNT(*) AS samples FROM k JOIN b ON b.outer_fold = k.outer_fold JOIN c ON c.session = CAST(k.t AS DATE) GROUP BY 1, 2, 3"""


@register("nested_validation", _NESTED)
def nested_validation(spark: SparkSession, d: str) -> DataFrame:
    outer = validation.walk_forward(samples(spark, d), sessions(spark, d), 500, 120, 60, 250, 5, True)
    out = validation.nested(samples(spark, d), sessions(spark, d), outer, 3, 1)
    return out.groupBy("outer_fold", "inner_fold", "role").agg(F.count(F.lit(1)).alias("samples"))


@register("minute_split", "SELECT part, COUNT(*) AS labels FROM (SELECT CASE WHEN e < 2000 THEN CASE WHEN e + 40 <= 2000 THEN 'train' ELSE 'purged_train_boundary' END WHEN e < 2100 THEN 'embargo_after_train' WHEN e < 5000 THEN CASE WHEN e + 40 <= 5000 THEN 'validation' ELSE 'purged_validation_boundary' END WHEN e < 5100 THEN 'embargo_after_validation' WHEN e < 9000 THEN CASE WHEN e + 40 <= 9000 THEN 'test' ELSE 'purged_test_boundary' END ELSE 'outside' END AS part FROM (SELECT event_id AS e FROM events)) GROUP BY 1")
def minute_split(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "events").select("event_id", (F.col("event_id") + 40).alias("out"))
    return validation.split_minutes(rows, "event_id", "out", 2000, 5000, 9000, 100).groupBy("part").agg(F.count(F.lit(1)).alias("labels"))


@register("fit_scope", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'not_certified' ELSE 'not_fitted' END AS finding FROM orders WHERE (o_orderkey % 7 = 0) <> (o_orderkey % 11 = 0)")
def fit_scope(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "orders")
    return validation.fit_scope(rows.where("o_orderkey % 7 = 0"), rows.where("o_orderkey % 11 = 0"), ["o_orderkey"])


@register("trial_states", "SELECT o_orderkey AS trial, CASE o_orderkey % 3 WHEN 0 THEN 'completed' WHEN 1 THEN 'failed' ELSE 'pruned' END AS state, 2 AS events FROM orders")
def trial_states(spark: SparkSession, d: str) -> DataFrame:
    ends = F.element_at(F.array(F.lit("completed"), F.lit("failed"), F.lit("pruned")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    rows = scan(spark, d, "orders").select(F.col("o_orderkey").alias("trial"), F.posexplode(F.array(F.lit("started"), ends)).alias("seq", "event"))
    return validation.trial_states(rows)


# Models ----------------------------------------------------------------------------------------

_NAMES = ["qty", "disc", "tax", "price"]


def long_features(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("entity_id")).agg(F.sum("l_quantity").alias("qty"), F.round(F.avg("l_discount"), 8).alias("disc"), F.round(F.avg("l_tax"), 8).alias("tax"), F.round(F.sum("l_extendedprice") / 1000, 8).alias("price"), F.max("l_shipdate").alias("t"))
    parts = F.array(*[F.struct(F.lit(n).alias("feature_id"), F.col(n).cast("double").alias("value")) for n in _NAMES])
    out = rows.select("entity_id", F.explode(parts).alias("f"), "t").select("entity_id", "f.feature_id", "f.value", F.col("t").alias("observation_time"), F.col("t").alias("available_time"), F.col("f.feature_id").alias("lineage"))
    return out.where("not (feature_id = 'disc' and entity_id % 10 = 0)")


def sample_frame(spark: SparkSession, d: str) -> DataFrame:
    labels = scan(spark, d, "orders").select(F.col("o_orderkey").alias("entity_id"), (F.col("o_totalprice") / 100_000).alias("y"))
    return modeling.wide_samples(long_features(spark, d), labels, ["entity_id"], _NAMES, "y")


_WIDE = "SELECT l_orderkey AS entity_id, SUM(l_quantity) AS qty, CASE WHEN l_orderkey % 10 <> 0 THEN ROUND(AVG(l_discount), 8) END AS disc, ROUND(AVG(l_tax), 8) AS tax, ROUND(SUM(l_extendedprice) / 1000, 8) AS price, MAX(l_shipdate) AS max_available_time, ANY_VALUE(o_totalprice) / 100000 AS target FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1"


@register("model_samples", f"SELECT entity_id, ROUND(qty, 6) AS qty, ROUND(disc, 6) AS disc, ROUND(tax, 6) AS tax, ROUND(price, 6) AS price, max_available_time, ROUND(target, 9) AS target FROM ({_WIDE})")
def model_samples(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rounded(sample_frame(spark, d), *_NAMES), "target", digits=9).select("entity_id", *_NAMES, "max_available_time", "target")


@register(
    "fold_preprocess",
    f"""WITH w AS ({_WIDE}), t AS (SELECT * FROM w WHERE entity_id % 4 <> 0), m AS (SELECT MEDIAN(disc) AS md FROM t), f AS (SELECT t.*, COALESCE(disc, md) AS d2 FROM t, m), s AS (SELECT AVG(d2) AS ad, STDDEV_POP(d2) AS sd, AVG(price) AS ap, STDDEV_POP(price) AS sp FROM f)
SELECT entity_id, ROUND((COALESCE(disc, md) - ad) / sd, 5) AS disc, ROUND((price - ap) / sp, 5) AS price FROM w, m, s WHERE entity_id % 4 = 0""",
)
def fold_preprocess(spark: SparkSession, d: str) -> DataFrame:
    rows = sample_frame(spark, d)
    fitted = modeling.fit_preprocessor(rows.where("entity_id % 4 <> 0"), ["disc", "price"])
    return rounded(fitted.transform(rows.where("entity_id % 4 = 0"), ["entity_id"]), "disc", "price", digits=5)


@register(
    "ridge_fold_scores",
    f"""WITH w AS ({_WIDE}), t AS (SELECT * FROM w WHERE entity_id % 4 <> 0), g AS (SELECT COUNT(*) AS n, AVG(qty) AS mx, AVG(price) AS mp, AVG(target) AS my, COVAR_POP(qty, qty) * COUNT(*) + 2.0 AS a, COVAR_POP(qty, price) * COUNT(*) AS b, COVAR_POP(price, price) * COUNT(*) + 2.0 AS c, COVAR_POP(qty, target) * COUNT(*) AS u, COVAR_POP(price, target) * COUNT(*) AS v FROM t),
k AS (SELECT (c * u - b * v) / (a * c - b * b) AS b1, (a * v - b * u) / (a * c - b * b) AS b2, mx, mp, my FROM g), p AS (SELECT target AS y, my + b1 * (qty - mx) + b2 * (price - mp) AS yhat, entity_id % 2 AS part FROM w, k WHERE entity_id % 4 = 0)
SELECT 'neg_mean_squared_error' AS objective, ROUND(-AVG((y - yhat) * (y - yhat)), 6) AS score, COUNT(*) AS rows FROM p UNION ALL SELECT 'neg_mean_absolute_error', ROUND(-AVG(ABS(y - yhat)), 6), COUNT(*) FROM p""",
)
def ridge_fold_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = sample_frame(spark, d)
    model = modeling.fit_ridge(rows.where("entity_id % 4 <> 0"), ["qty", "price"], "target", 2.0)
    scored = rows.where("entity_id % 4 = 0").withColumn("prediction", model.predict())
    parts = [modeling.fold_scores(scored, [], o).select(F.lit(o).alias("objective"), F.round("score", 6).alias("score"), "rows") for o in ("neg_mean_squared_error", "neg_mean_absolute_error")]
    return parts[0].unionByName(parts[1])


@register("model_selection")
def model_selection(spark: SparkSession, d: str) -> DataFrame:
    rows = sample_frame(spark, d)
    train, test = rows.where("entity_id % 4 <> 0"), rows.where("entity_id % 4 = 0")
    out = None
    for alpha in (0.1, 10.0, 1000.0):
        prepared = modeling.fit_preprocessor(train, _NAMES, select=3)
        model = modeling.fit_ridge(prepared.transform(train, ["target"]), prepared.selected, "target", alpha)
        part = modeling.fold_scores(prepared.transform(test, ["target"]).withColumn("prediction", model.predict()), [], "neg_mean_squared_error").withColumn("candidate", F.lit(f"ridge-{alpha:g}"))
        out = part if out is None else out.unionByName(part)
    return ranking.select_candidate(out, "score", "candidate", "maximize")


# Causal time -----------------------------------------------------------------------------------


@register(
    "feature_time_facts",
    "SELECT l_orderkey AS entity_id, MAX(l_shipdate) AS max_observation_time, MAX(l_shipdate) + INTERVAL 1 DAY AS max_available_time, array_to_string(list_sort(list_distinct(list('p' || CAST(l_linenumber % 3 AS VARCHAR)))), ',') AS partitions FROM lineitem GROUP BY 1",
)
def feature_time_facts(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "lineitem").select(F.col("l_orderkey").alias("entity_id"), F.lit("2030-01-01").cast("timestamp_ntz").alias("decision"), F.col("l_shipdate").alias("seen"), (F.col("l_shipdate") + F.expr("interval 1 day")).alias("available"), F.concat(F.lit("p"), (F.col("l_linenumber") % 3).cast("string")).alias("part"))
    facts = causal.require_known(causal.feature_time_facts(rows, ["entity_id"], "decision", "seen", "available", "part"))
    return facts.select("entity_id", "max_observation_time", "max_available_time", F.array_join("source_partition_ids", ",").alias("partitions"))


@register("next_open_trace", "SELECT session, CAST(session AS TIMESTAMP) + INTERVAL 15 HOUR AS decision_time, CAST(nxt AS TIMESTAMP) + INTERVAL 565 MINUTE AS order_time, CAST(nxt AS TIMESTAMP) + INTERVAL 570 MINUTE AS fill_time FROM (SELECT session, LEAD(session) OVER (ORDER BY session) AS nxt FROM (" + _SESSIONS + ")) WHERE nxt IS NOT NULL", dates=("session",))
def next_open_trace(spark: SparkSession, d: str) -> DataFrame:
    return causal.next_open_trace(sessions(spark, d), "session")


@register("session_offset", f"SELECT session, LEAD(session, 5) OVER (ORDER BY session) AS fifth FROM ({_SESSIONS})", dates=("session", "fifth"))
def session_offset(spark: SparkSession, d: str) -> DataFrame:
    return causal.session_at_offset(sessions(spark, d), "session", 5, "fifth")


@register("completed_bar_trace", "SELECT event_id, ts AS event_time, ts + INTERVAL 1 MINUTE AS observation_time, ts + INTERVAL 1 MINUTE AS available_time FROM events")
def completed_bar_trace(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "events").select("event_id", "ts", (F.col("ts") + F.expr("interval 1 minute")).alias("end"))
    return causal.completed_bar_trace(rows, "ts", "end").select("event_id", "event_time", "observation_time", "available_time")


@register("label_time_rules", "SELECT COUNT(*) AS labels FROM orders")
def label_time_rules(spark: SparkSession, d: str) -> DataFrame:
    return causal.require_future(samples(spark, d), "decision_time", "label_start", "label_end", "label_available").agg(F.count(F.lit(1)).alias("labels"))


@register("statement_visibility", "SELECT o_orderkey FROM orders WHERE o_orderdate <= TIMESTAMP '1996-06-30' AND (o_orderkey % 3 <> 0 OR o_orderdate + INTERVAL 90 DAY <= TIMESTAMP '1996-06-30')")
def statement_visibility(spark: SparkSession, d: str) -> DataFrame:
    rows = scan(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("published"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate") + F.expr("interval 90 days")).alias("revised"))
    return causal.statement_visible(rows, "published", "revised", F.lit("1996-06-30").cast("timestamp_ntz")).select("o_orderkey")


@register("metric_rows", "SELECT * FROM (SELECT 'data.row_count' AS metric_ref, CAST(COUNT(*) AS DOUBLE) AS value, 'rows' AS unit, COUNT(*) AS sample_size, 'observed' AS status FROM events UNION ALL SELECT 'minute.row_count', CAST(COUNT(DISTINCT user_id) AS DOUBLE), 'users', COUNT(*), 'observed' FROM events)")
def metric_rows(spark: SparkSession, d: str) -> DataFrame:
    metrics = [("data.row_count", F.count(F.lit(1)), "rows"), ("minute.row_count", F.count_distinct("user_id"), "users")]
    return causal.metric_rows(scan(spark, d, "events"), metrics, "ts", "ts").drop("sample_start", "sample_end")
