"""Inference and performance statistics; sums run in Spark, closed forms on the few numbers left."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.functions.scalars import expected_maximum, normal_cdf, two_sided_p
from tidemark.operators.pit import guard

# Means under dependence ------------------------------------------------------------------------


def hac_mean(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, lag: int) -> DataFrame:
    """Mean with a Bartlett-kernel (Newey-West) standard error, per group.

    Lagged products come from one window; a group's variance is one expression over its sums.
    """
    if lag < 0:
        raise ContractError("a lag is not negative")
    w = Window.partitionBy(*group)
    rows = df.where(F.col(value).isNotNull()).withColumn("__c", F.col(value) - F.avg(value).over(w))
    ordered = w.orderBy(*order)
    products = [(F.col("__c") * F.lag("__c", k).over(ordered)).alias(f"__p{k}") for k in range(1, lag + 1)]
    rows = rows.select(*group, value, "__c", *products)
    n = F.count(F.lit(1))
    parts = rows.groupBy(*group).agg(n.alias("sample_size"), F.avg(value).alias("estimate"), F.sum(F.col("__c") * F.col("__c")).alias("__g0"), *[F.coalesce(F.sum(f"__p{k}"), F.lit(0.0)).alias(f"__g{k}") for k in range(1, lag + 1)])
    long_run = F.col("__g0")
    for k in range(1, lag + 1):
        long_run = long_run + 2.0 * (1.0 - k / (lag + 1.0)) * F.col(f"__g{k}")
    size = F.col("sample_size")
    variance = F.greatest(long_run / size / size, F.lit(0.0))
    out = parts.withColumn("__v", variance)
    effective = F.greatest(F.lit(1.0), F.least(size.cast("double"), F.col("__g0") / size / F.col("__v")))
    return out.select(*group, "sample_size", "estimate", F.sqrt("__v").alias("standard_error"), F.when(F.col("__v") > 0, effective).alias("effective_sample_size"), F.when(F.col("__v") > 0, F.col("estimate") / F.sqrt("__v")).alias("z_value"))


def overlap_lag(df: DataFrame, group: Sequence[str], start: str, end: str) -> DataFrame:
    """Most later intervals that begin before an interval ends, per group.

    Starts and ends are stacked in one order, so that counting is a window: the starts before an
    interval's end, less the rank of its own start.
    """
    rows = df.select(*group, F.col(start).alias("__s"), F.col(end).alias("__e")).withColumn("__rank", F.row_number().over(Window.partitionBy(*group).orderBy("__s", "__e")))
    starts = rows.select(*group, F.col("__s").alias("__t"), F.lit(1).alias("__is"), F.lit(None).cast("int").alias("__rank"))
    ends = rows.select(*group, F.col("__e").alias("__t"), F.lit(0).alias("__is"), F.col("__rank"))
    w = Window.partitionBy(*group).orderBy("__t", "__is").rowsBetween(Window.unboundedPreceding, 0)  # an end counts the starts strictly before it
    counted = starts.unionByName(ends).withColumn("__n", F.sum("__is").over(w))
    return counted.where("__is = 0").groupBy(*group).agg(F.greatest(F.max(F.col("__n") - F.col("__rank")), F.lit(0)).alias("overlap_lag"))


def _cluster_part(rows: DataFrame, group: Sequence[str], cluster: Sequence[str], name: str) -> DataFrame:
    sums = rows.groupBy(*group, *cluster).agg(F.sum("__c").alias("__s"), F.count(F.lit(1)).alias("__k"))
    count, total = F.count(F.lit(1)), F.sum("__k")
    return sums.groupBy(*group).agg(count.alias(f"{name}_count"), (count / (count - 1.0) * F.sum(F.col("__s") * F.col("__s")) / (total * total)).alias(f"__v_{name}"))


def cluster_mean(df: DataFrame, group: Sequence[str], value: str, first: str, second: str | None = None) -> DataFrame:
    """Mean with a cluster-robust standard error; two ways by inclusion and exclusion."""
    rows = df.where(F.col(value).isNotNull()).withColumn("__c", F.col(value) - F.avg(value).over(Window.partitionBy(*group)))
    base = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("sample_size"), F.avg(value).alias("estimate"))
    out = base.join(_cluster_part(rows, group, [first], "first"), list(group))
    variance = F.col("__v_first")
    if second is not None:
        out = out.join(_cluster_part(rows, group, [second], "second"), list(group)).join(_cluster_part(rows, group, [first, second], "both"), list(group))
        variance = F.col("__v_first") + F.col("__v_second") - F.col("__v_both")
    out = out.withColumn("standard_error", F.when(variance > 0, F.sqrt(variance)))
    return out.drop(*[c for c in out.columns if c.startswith("__v_")])


def event_inference(rows: DataFrame, offset: str, value: str, entity: str, time: str) -> DataFrame:
    """Average and cumulative abnormal return for each relative session, two-way clustered."""
    each = cluster_mean(rows, [offset], value, entity, time)
    w = Window.orderBy(offset).rowsBetween(Window.unboundedPreceding, 0)  # one row for each relative session
    return each.withColumn("cumulative", F.sum("estimate").over(w)).withColumn("z_value", F.col("estimate") / F.col("standard_error"))


# Many tests ------------------------------------------------------------------------------------

METHODS = ("bonferroni", "holm", "benjamini_hochberg", "benjamini_yekutieli")


def adjust_p(df: DataFrame, family: Sequence[str], p: str, candidate: str, method: str, independent: bool = False) -> DataFrame:
    """``adjusted_p`` within each family; Benjamini-Hochberg has to be told that tests allow it."""
    if method not in METHODS:
        raise ContractError(f"no adjustment {method}")
    if method == "benjamini_hochberg" and not independent:
        raise ContractError("Benjamini-Hochberg needs independent or positively dependent tests")
    w = Window.partitionBy(*family)
    n = F.count(F.lit(1)).over(w)
    ordered = w.orderBy(F.col(p), F.col(candidate))
    rows = df.withColumn("__n", n).withColumn("__k", F.row_number().over(ordered))
    if method == "bonferroni":
        adjusted = F.col(p) * F.col("__n")
    elif method == "holm":
        rows = rows.withColumn("__raw", F.col(p) * (F.col("__n") - F.col("__k") + 1))
        adjusted = F.max("__raw").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    else:
        # 1 + 1/2 + ... + 1/n, as the largest of the family's running sums
        running = F.lit(1.0) if method == "benjamini_hochberg" else F.sum(1.0 / F.col("__k")).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.withColumn("__h", running).withColumn("__h", F.max("__h").over(w))
        rows = rows.withColumn("__raw", F.col(p) * F.col("__n") * F.col("__h") / F.col("__k"))
        adjusted = F.min("__raw").over(ordered.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("adjusted_p", F.least(F.lit(1.0), adjusted))
    return rows.drop("__n", "__k", "__h", "__raw")


@dataclass(frozen=True)
class Family:
    """A family of tests, fixed before any of them is read: adjusting takes all of its results or none."""

    name: str
    candidates: tuple[str, ...]
    metric: str
    direction: str = "two_sided"
    alpha: float = 0.05
    independent: bool = False

    def __post_init__(self) -> None:
        sound = self.name.strip() and self.metric.strip() and self.candidates and len(set(self.candidates)) == len(self.candidates)
        if not sound or self.direction not in ("greater", "less", "two_sided") or not 0 < self.alpha < 1:
            raise ContractError("a family has a name, a metric, candidates that differ, a direction, and an alpha between 0 and 1")

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps([self.name, self.candidates, self.metric, self.direction, self.alpha, self.independent]).encode()).hexdigest()

    def complete(self, results: DataFrame, candidate: str, p: str) -> DataFrame:
        """The results if they are one p-value in [0, 1] for each candidate of the family; else an error."""
        known = results.sparkSession.createDataFrame([(c,) for c in self.candidates], "__c string")
        both = results.join(known, F.col(candidate) == F.col("__c"), "full_outer").withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("__c")))
        sound = F.col("__c").isNotNull() & F.col(candidate).isNotNull() & (F.col("__n") == 1) & F.col(p).between(0, 1)
        return both.where(guard(F.coalesce(sound, F.lit(False)), "results have to be complete for the family")).drop("__c", "__n")

    def adjust(self, results: DataFrame, candidate: str, p: str, method: str) -> DataFrame:
        out = adjust_p(self.complete(results, candidate, p).withColumn("__f", F.lit(1)), ["__f"], p, candidate, method, self.independent).drop("__f")
        return out.withColumn("passes_alpha", F.col("adjusted_p") <= self.alpha)


def inference(df: DataFrame, estimate: str = "estimate", error: str = "standard_error", confidence: float = 0.95) -> DataFrame:
    """Adds confidence_low, confidence_high and a two-sided p_value; a standard error that is not positive is an error."""
    if not 0 < confidence < 1:
        raise ContractError("a confidence lies between 0 and 1")
    z = NormalDist().inv_cdf(0.5 + confidence / 2)

    @F.pandas_udf("double")
    def p_value(z: pd.Series) -> pd.Series:
        return z.map(two_sided_p, na_action="ignore")

    rows = df.where(guard(F.coalesce((F.col(error) > 0) & (F.col(error) < float("inf")), F.lit(False)), "a standard error is not positive"))
    return rows.withColumns({"confidence_low": F.col(estimate) - z * F.col(error), "confidence_high": F.col(estimate) + z * F.col(error), "p_value": p_value(F.col(estimate) / F.col(error))})


@dataclass(frozen=True)
class MinuteProfile:
    """Borders of a minute study, in the labels' own unit of time, and how its candidates are tested."""

    family: Family
    train_end: int
    validation_end: int
    test_end: int
    embargo: int
    lag: int
    method: str = "holm"
    least: int = 3


def overlap_floors(labels: DataFrame, candidate: str = "candidate", entry: str = "entry", exit_: str = "exit") -> DataFrame:
    """One row: the least lag (later labels that begin before one ends) and embargo (longest label) that candidates need."""
    lags = overlap_lag(labels, [candidate], entry, exit_).agg(F.coalesce(F.max("overlap_lag"), F.lit(0)).alias("lag_floor"))
    spans = labels.agg(F.coalesce(F.max(F.col(exit_) - F.col(entry)), F.lit(0)).alias("embargo_floor"))
    return lags.crossJoin(F.broadcast(spans))  # one row each


def minute_statistics(labels: DataFrame, profile: MinuteProfile) -> tuple[DataFrame, DataFrame]:
    """Trials and report of a minute study over labels (candidate, observation_id, entry, exit, value).

    Trials: for every candidate of the family its test labels, mean, raw and adjusted p-value. One with
    too few test labels or without variance has p = 1. Report: one row with the floors, the issues
    and the status. Labels of candidates outside the family are an error.
    """
    from tidemark.operators.validation import split_minutes

    spark, family = labels.sparkSession, profile.family
    known = spark.createDataFrame([(c,) for c in family.candidates], "candidate string")
    rows = labels.withColumn("candidate", F.col("candidate").cast("string"))
    rows = rows.where(guard(F.col("candidate").isin(*family.candidates), "a label's candidate is not in the family"))
    parts = split_minutes(rows, "entry", "exit", profile.train_end, profile.validation_end, profile.test_end, profile.embargo)
    tested = hac_mean(parts.where("part = 'test'"), ["candidate"], ["entry", "observation_id"], "value", profile.lag)
    enough = (F.col("sample_size") >= max(profile.least, 3)) & (F.col("sample_size") > profile.lag) & F.col("z_value").isNotNull()

    @F.pandas_udf("double")
    def p_value(z: pd.Series) -> pd.Series:
        return z.map(two_sided_p, na_action="ignore")

    trials = known.join(tested, "candidate", "left").select("candidate", F.coalesce("sample_size", F.lit(0)).alias("sample_count"), F.when(enough, F.col("estimate")).alias("estimate"), F.coalesce(p_value(F.when(enough, F.col("z_value"))), F.lit(1.0)).alias("raw_p"))
    trials = family.adjust(trials, "candidate", "raw_p", profile.method)
    seen = known.join(rows.select("candidate").distinct().withColumn("__seen", F.lit(1)), "candidate", "left").agg(F.count_if(F.col("__seen").isNull()).alias("unseen"))
    weak = trials.agg(F.count_if(F.col("estimate").isNull()).alias("weak"))
    facts = overlap_floors(rows).crossJoin(F.broadcast(seen)).crossJoin(F.broadcast(weak))  # one row each
    issues = F.array_compact(F.array(
        F.when(F.col("unseen") > 0, F.lit("search.minute_trial_universe_incomplete")), F.when(F.col("embargo_floor") > profile.embargo, F.lit("split.embargo_below_floor")),
        F.when(F.col("lag_floor") > profile.lag, F.lit("statistics.hac_below_floor")), F.when(F.col("weak") > 0, F.lit("statistics.minute_sample_invalid")),
    ))
    report = facts.select("lag_floor", "embargo_floor", F.array_join(issues, ",").alias("issue_codes"), F.when(F.size(issues) == 0, "pass").otherwise("fail").alias("status"))
    return trials, report


def minute_validity(reported: DataFrame, labels: DataFrame, profile: MinuteProfile, digits: int = 9) -> DataFrame:
    """Findings (check, key, expected, stated) of a study's reported trials against what its labels give."""
    again = minute_statistics(labels, profile)[0]
    told = reported.select(F.col("candidate").alias("__c"), *[F.col(c).alias(f"__{c}") for c in ("sample_count", "estimate", "raw_p", "adjusted_p")])
    both = again.join(told, F.col("candidate") == F.col("__c"), "full_outer").withColumn("key", F.coalesce("candidate", "__c"))
    text = lambda c: F.col(c).cast("string") if c.endswith("sample_count") else F.round(c, digits).cast("string")
    checks = [F.when(~text(c).eqNullSafe(text(f"__{c}")), F.struct(F.lit(f"minute_{c}").alias("check"), "key", text(c).alias("expected"), text(f"__{c}").alias("stated"))) for c in ("sample_count", "estimate", "raw_p", "adjusted_p")]
    return both.select(F.explode(F.array_compact(F.array(*checks))).alias("f")).select("f.*")


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation, null where either side is constant."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


# Selection bias --------------------------------------------------------------------------------


def sharpe_moments(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Per group: n, Sharpe ratio (sample deviation), raw skew and raw kurtosis by that deviation."""
    w = Window.partitionBy(*group)
    rows = df.where(F.col(value).isNotNull()).withColumn("__z", F.try_divide(F.col(value) - F.avg(value).over(w), F.stddev_samp(value).over(w)))
    return rows.groupBy(*group).agg(F.count(F.lit(1)).alias("sample_size"), F.try_divide(F.avg(value), F.stddev_samp(value)).alias("sharpe"), F.avg(F.pow("__z", F.lit(3))).alias("skew"), F.avg(F.pow("__z", F.lit(4))).alias("kurtosis"))


def psr_z(moments: DataFrame, benchmark: float = 0.0) -> DataFrame:
    """The normal score of the probabilistic Sharpe ratio."""
    s = F.col("sharpe")
    bottom = 1.0 - F.col("skew") * s + (F.col("kurtosis") - 1.0) / 4.0 * s * s
    return moments.withColumn("z_value", F.when(bottom > 0, (s - benchmark) * F.sqrt(F.col("sample_size") - 1.0) / F.sqrt(bottom)))


def probabilistic_sharpe(df: DataFrame, group: Sequence[str], value: str, benchmark: float = 0.0) -> DataFrame:
    """Probability that the Sharpe ratio exceeds the benchmark."""

    @F.pandas_udf("double")
    def cdf(z: pd.Series) -> pd.Series:
        return z.map(normal_cdf, na_action="ignore")

    return psr_z(sharpe_moments(df, group, value), benchmark).withColumn("probability", cdf("z_value"))


#: Bytes of candidate returns that may be gathered on the driver.
MATRIX_BYTES = 64 << 20


def matrix_of(df: DataFrame, order: str, candidate: str, value: str) -> tuple[np.ndarray, list[str]]:
    """Candidate returns as a matrix of periods by candidates; more than ``MATRIX_BYTES`` is an error."""
    size = df.agg(F.count_distinct(order).alias("periods"), F.count_distinct(candidate).alias("candidates")).first()
    if 8 * size.periods * size.candidates > MATRIX_BYTES:
        raise ContractError(f"{size.periods} periods of {size.candidates} candidates pass the budget of {MATRIX_BYTES} bytes")
    wide = df.groupBy(order).pivot(candidate).agg(F.first(value)).orderBy(order).toPandas()
    names = [c for c in wide.columns if c != order]
    return wide[names].to_numpy(float), names


def correlation_squares(df: DataFrame, order: str, candidate: str, value: str) -> DataFrame:
    """(first, second, correlation) for every ordered pair of candidates, by a join on the period."""
    a = df.select(F.col(order).alias("__t"), F.col(candidate).alias("first"), F.col(value).alias("x"))
    b = df.select(F.col(order).alias("__t"), F.col(candidate).alias("second"), F.col(value).alias("y"))
    return a.join(b, "__t").groupBy("first", "second").agg(correlation(F.col("x"), F.col("y")).alias("correlation"))


def effective_trials(df: DataFrame, order: str, candidate: str, value: str) -> DataFrame:
    """trials^2 over the sum of squared correlations, within [1, trials].

    Of a complete panel with more candidates than periods, the sum is that of the squared products of
    periods instead: both are the squared norm of the same matrix, and pairs are of the shorter side.
    """
    size = df.agg(F.count_distinct(order).alias("periods"), F.count_distinct(candidate).alias("candidates"), F.count(value).alias("values"), F.count(F.lit(1)).alias("rows")).first()
    if size.candidates <= size.periods or not size.values == size.rows == size.candidates * size.periods:
        squares = correlation_squares(df, order, candidate, value)
        n = F.sqrt(F.count(F.lit(1)).cast("double"))
        return squares.agg(n.alias("trials"), F.greatest(F.lit(1.0), F.least(n, n * n / F.sum(F.col("correlation") * F.col("correlation")))).alias("effective_trials"))
    w = Window.partitionBy(candidate)
    z = df.select(F.col(candidate).alias("c"), F.col(order).alias("t"), F.try_divide(F.col(value) - F.avg(value).over(w), F.stddev_pop(value).over(w)).alias("z"))
    products = z.join(z.select("c", F.col("t").alias("s"), F.col("z").alias("y")), "c").groupBy("t", "s").agg(F.sum(F.col("z") * F.col("y")).alias("p"))
    n = F.lit(float(size.candidates))
    return products.agg(n.alias("trials"), F.greatest(F.lit(1.0), F.least(n, n * n * size.periods * size.periods / F.sum(F.col("p") * F.col("p")))).alias("effective_trials"))


def deflated_sharpe(df: DataFrame, order: str, candidate: str, value: str, chosen: str) -> dict[str, float]:
    """Probability that the chosen candidate's Sharpe ratio beats the best of as many idle trials."""
    moments = sharpe_moments(df, [candidate], value)
    spread = moments.agg(F.stddev_samp("sharpe")).first()[0]
    trials = effective_trials(df, order, candidate, value).first().effective_trials
    benchmark = expected_maximum(float(spread), trials)
    m = psr_z(moments.where(F.col(candidate) == chosen), benchmark).first()
    return {"sharpe": float(m.sharpe), "benchmark": benchmark, "effective_trials": float(trials), "probability": normal_cdf(m.z_value)}


def overfitting_probability(scores: DataFrame, split: str, candidate: str, score: str) -> DataFrame:
    """Share of half splits whose best candidate in sample ranks in the lower half out of sample.

    A candidate's scores are one array in order of the splits, so that each half is a bit mask over
    it: candidates are the only rows, exploded by the masks. Ties are decided by the candidate.
    """
    names = sorted(r[0] for r in scores.select(split).distinct().limit(15).collect())  # 15 are too many already
    n = len(names)
    if n < 4 or n % 2 or n > 14:
        raise ContractError("an even number of 4 to 14 splits")
    place = (F.array_position(F.array(*map(F.lit, names)), F.col(split)) - 1).cast("int")
    by_place = F.map_from_entries(F.collect_list(F.struct(place.alias("k"), F.col(score).cast("double").alias("x"))))
    vectors = scores.groupBy(F.col(candidate).alias("c")).agg(by_place.alias("held")).select("c", F.expr(f"transform(sequence(0, {n - 1}), k -> try_element_at(held, k))").alias("x"))
    masks = f"filter(sequence(1, {(1 << n) - 1}), m -> bit_count(m) = {n // 2})"
    mean = lambda bit: F.expr(f"aggregate(sequence(0, {n - 1}), cast(struct(0.0D as s, 0 as n) as struct<s: double, n: int>), (a, k) -> if((shiftright(mask, k) & 1) = {bit} and x[k] is not null, struct(a.s + x[k] as s, a.n + 1 as n), a), a -> try_divide(a.s, a.n))")
    means = vectors.select("c", "x", F.explode(F.expr(masks)).alias("mask")).select("mask", "c", mean(1).alias("in_sample"), mean(0).alias("out_of_sample"))
    w = Window.partitionBy("mask")
    ranked = means.select("mask", F.row_number().over(w.orderBy(F.desc("in_sample"), "c")).alias("best"), F.row_number().over(w.orderBy("out_of_sample", "c")).alias("rank"), F.count(F.lit(1)).over(w).alias("n"))
    relative = (F.col("rank") - 0.5) / F.col("n")
    return ranked.where("best = 1").agg(F.avg((F.log(relative / (1 - relative)) <= 0).cast("double")).alias("probability"), F.count(F.lit(1)).alias("combinations"))


def seed_of(*parts) -> int:
    """A 63-bit seed that depends on every part and on their order."""
    return int(hashlib.blake2b(json.dumps(parts).encode(), digest_size=8).hexdigest(), 16) >> 1


def bootstrap_indices(method: str, n: int, block: int, seed: int, replication: int) -> np.ndarray:
    """Indices of one replication: circular moving blocks, or stationary blocks of mean length ``block``.

    Every replication has a generator of its own, so replications can run anywhere.
    """
    rng = np.random.default_rng([seed, replication])
    if method == "moving_block":
        starts = rng.integers(0, n, size=-(-n // block))
        return ((starts[:, None] + np.arange(block)) % n).ravel()[:n]
    if method != "stationary":
        raise ContractError("bootstrap is moving_block or stationary")
    fresh = rng.random(n) < 1.0 / block
    fresh[0] = True
    starts = np.where(fresh, rng.integers(0, n, size=n), 0)
    at = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    return (starts[at] + np.arange(n) - at) % n


def reality_check(df: DataFrame, order: str, candidate: str, value: str, method: str = "white", block: int = 5, replications: int = 500, root_seed: int = 7) -> DataFrame:
    """White's reality check or SPA: statistic and bootstrap p-value over all candidates.

    The matrix of candidate returns is a bounded table and goes to every task once; replications
    are rows of a range and run in parallel.
    """
    matrix, names = matrix_of(df, order, candidate, value)
    if len(matrix) < 8 or len(names) < 2 or method not in ("white", "spa"):
        raise ContractError("at least 8 periods and 2 candidates; white or spa")
    scale = matrix.std(axis=0, ddof=1) if method == "spa" else np.ones(len(names))
    centred, root = matrix - matrix.mean(axis=0), math.sqrt(len(matrix))
    observed = max(0.0, float((root * matrix.mean(axis=0) / scale).max()))
    seed = seed_of("reality check", method, root_seed, block, hashlib.sha256(matrix.tobytes()).hexdigest())
    spark = df.sparkSession
    held = spark.sparkContext.broadcast((centred, scale))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centred, scale = held.value
        for batch in batches:
            out = [max(0.0, float((root * centred[bootstrap_indices("stationary", len(centred), block, seed, int(k))].mean(axis=0) / scale).max())) for k in batch["id"]]
            yield pd.DataFrame({"statistic": out})

    boot = spark.range(replications).mapInPandas(run, "statistic double")
    return boot.agg(F.lit(observed).alias("statistic"), ((1 + F.sum((F.col("statistic") >= observed).cast("int"))) / (F.count(F.lit(1)) + 1)).alias("p_value"), F.count(F.lit(1)).alias("replications"))


# Performance -----------------------------------------------------------------------------------


def portfolio_metrics(df: DataFrame, group: Sequence[str], order: Sequence[str], returns: str, equity: str, turnover: str, annual: int) -> DataFrame:
    """Total return, drawdown from the running equity peak, volatility and Sharpe (population), turnover."""
    peak = F.max(equity).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = df.withColumn("__dd", F.col(equity) / peak - 1)
    deviation = F.stddev_pop(returns)
    return rows.groupBy(*group).agg(
        F.coalesce(F.product(1.0 + F.col(returns)) - 1.0, F.lit(0.0)).alias("total_return"),
        F.coalesce(F.min("__dd"), F.lit(0.0)).alias("max_drawdown"),
        F.when(F.count(returns) >= 2, deviation * math.sqrt(annual)).otherwise(0.0).alias("annualized_volatility"),
        F.when(F.coalesce(deviation, F.lit(0.0)) != 0, F.avg(returns) / deviation * math.sqrt(annual)).otherwise(0.0).alias("sharpe"),
        F.coalesce(F.avg(turnover), F.lit(0.0)).alias("turnover_mean"),
    )


def result_statistics(df: DataFrame, group: Sequence[str], date: str, value: str, semantics: str, periods: int | None = None) -> DataFrame:
    """Counts, mean, signs, best and worst with dates, first and last, and for returns the compounded path.

    Drawdown starts from a value of 1. ``semantics`` is level, simple_return or log_return.
    """
    if semantics not in ("level", "simple_return", "log_return"):
        raise ContractError("semantics are level, simple_return or log_return")
    v = F.col(value)
    w = Window.partitionBy(*group).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    grown = v if semantics == "log_return" else F.log1p(v)
    rows = df.where(v.isNotNull())
    if semantics != "level":
        rows = rows.withColumn("__net", F.exp(F.sum(grown).over(w)))
        rows = rows.withColumn("__dd", F.col("__net") / F.greatest(F.max("__net").over(w), F.lit(1.0)) - 1)
    first = lambda best: F.max_by(F.struct(F.col(date).alias("d"), v.alias("v")), best)
    day = F.datediff(F.col(date).cast("date"), F.lit("1970-01-01").cast("date"))
    cols = [
        F.count(F.lit(1)).alias("count"), F.avg(v).alias("mean"),
        F.count_if(v > 0).alias("positive_count"), F.count_if(v < 0).alias("negative_count"), F.count_if(v == 0).alias("zero_count"),
        first(F.struct(v, -day)).alias("__best"), first(F.struct(-v, -day)).alias("__worst"),
        F.min_by(v, F.col(date)).alias("first_value"), F.max_by(v, F.col(date)).alias("last_value"),
    ]
    if semantics != "level":
        cols += [F.max_by("__net", F.col(date)).alias("__end"), F.least(F.min("__dd"), F.lit(0.0)).alias("max_drawdown")]
    out = rows.groupBy(*group).agg(*cols)
    out = out.select("*", F.col("__best.v").alias("best_value"), F.col("__best.d").alias("best_date"), F.col("__worst.v").alias("worst_value"), F.col("__worst.d").alias("worst_date"), (F.col("last_value") - F.col("first_value")).alias("absolute_change"))
    if semantics != "level":
        out = out.withColumn("compounded_return", F.col("__end") - 1)
        if periods:
            out = out.withColumn("geometric_annualized_return", F.pow(F.col("__end"), periods / F.col("count")) - 1)
    return out.drop("__best", "__worst", "__end")


def calendar_years(df: DataFrame, date: str, value: str, policy: str = "include") -> DataFrame:
    """Statistics for each calendar year of the range, years without rows included.

    ``policy`` for partial years, those that the range does not cover from January to December:
    include, exclude, or reject (an error).
    """
    if policy not in ("include", "exclude", "reject"):
        raise ContractError("partial years are included, excluded or rejected")
    span = df.agg(F.min(F.col(date).cast("date")).alias("lo"), F.max(F.col(date).cast("date")).alias("hi"))
    years = span.select(F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("year"), "lo", "hi")
    whole = (F.col("lo") <= F.make_date("year", F.lit(1), F.lit(1))) & (F.col("hi") >= F.make_date("year", F.lit(12), F.lit(31)))
    years = years.select("year", whole.alias("complete_year"))
    if policy == "exclude":
        years = years.where("complete_year")
    if policy == "reject":
        years = years.where(F.when(F.col("complete_year"), F.lit(True)).otherwise(F.raise_error(F.lit("a calendar year is partial")).cast("boolean")))
    each = df.groupBy(F.year(F.col(date)).alias("__y")).agg(F.count(F.lit(1)).alias("count"), F.avg(value).alias("mean"), F.count_if(F.col(value) > 0).alias("positive_count"))
    return years.join(each, F.col("year") == F.col("__y"), "left").select("year", "complete_year", F.coalesce("count", F.lit(0)).alias("count"), "mean", F.coalesce("positive_count", F.lit(0)).alias("positive_count"))


def comparable(runs: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Reason codes of the fields in which runs differ; comparable if there are none."""
    checks = [F.when(F.count_distinct(F.coalesce(F.col(f).cast("string"), F.lit("\0"))) > 1, F.lit(f"{f}_differs")) for f in fields]
    one = runs.agg(F.array(*checks).alias("__r"))
    reasons = F.filter("__r", lambda r: r.isNotNull())
    return one.select((F.size(reasons) == 0).alias("comparable"), F.array_join(reasons, ",").alias("reason_codes"))
