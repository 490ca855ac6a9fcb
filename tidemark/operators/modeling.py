"""Daily models: samples in wide form, fold-local preprocessing, fitting, prediction and scores."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators.pit import guard
from tidemark.operators.statistics import correlation


def wide_samples(features: DataFrame, labels: DataFrame, keys: Sequence[str], names: Sequence[str], target: str) -> DataFrame:
    """Long features (keys, feature_id, value, observation_time, available_time, lineage) joined to labels.

    Every sample has one row; repeated features or labels are errors, missing ones null. The names
    are given, so that the pivot needs no pass of its own.
    """
    once = features.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys, "feature_id"))).where(guard(F.col("__n") == 1, "a feature is given twice"))
    lineage = F.sha2(F.array_join(F.array_sort(F.collect_set("lineage")), "|"), 256)
    meta = once.groupBy(*keys).agg(F.max("observation_time").alias("max_observation_time"), F.max("available_time").alias("max_available_time"), lineage.alias("lineage_hash"))
    values = once.groupBy(*keys).pivot("feature_id", list(names)).agg(F.first("value"))
    one = labels.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where(guard(F.col("__n") == 1, "a label is given twice"))
    return values.join(meta, list(keys)).join(one.select(*keys, F.col(target).alias("target")), list(keys))


@dataclass(frozen=True)
class Preprocessor:
    """Medians, means and scales of a training set, and the features chosen there."""

    columns: tuple[str, ...]
    selected: tuple[str, ...]
    medians: dict[str, float]
    means: dict[str, float]
    scales: dict[str, float]
    standardise: bool = True

    def filled(self, column: str) -> Column:
        c = F.col(column).cast("double")
        return F.when(c.isNull() | F.isnan(c), F.lit(self.medians[column])).otherwise(c)

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        scaled = lambda c: (self.filled(c) - self.means[c]) / self.scales[c] if self.standardise else self.filled(c)
        return df.select(*keep, *[scaled(c).alias(c) for c in self.selected])


def fit_preprocessor(train: DataFrame, columns: Sequence[str], target: str = "target", select: int | None = None, standardise: bool = True) -> Preprocessor:
    """Fill with training medians, scale by population deviation (0: 1), keep the ``select`` features
    that correlate most with the target, ties by name.

    One aggregate gives medians and moments of what is there, and so those of what will be filled; only
    a choice of features reads the training rows again.
    """
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    parts = [x.alias(f"{c}__{k}") for c in columns for k, x in (("d", F.coalesce(F.median(number(c)), F.lit(0.0))), ("n", F.count(number(c))), ("m", F.coalesce(F.avg(number(c)), F.lit(0.0))), ("v", F.coalesce(F.var_pop(number(c)), F.lit(0.0))))]
    first = train.agg(F.count(F.lit(1)).alias("rows"), *parts).first()
    medians, means, scales = {}, {}, {}
    for c in columns:
        median, n, mean, variance = (first[f"{c}__{k}"] for k in "dnmv")
        rows, lost = max(first["rows"], 1), first["rows"] - n
        whole = (n * mean + lost * median) / rows
        spread = math.sqrt((n * (variance + (mean - whole) ** 2) + lost * (median - whole) ** 2) / rows)
        medians[c], means[c], scales[c] = float(median), float(whole), spread or 1.0
    second = {}
    if select is not None and select < len(columns):
        fill = lambda c: F.coalesce(number(c), F.lit(medians[c]))
        second = train.agg(*[correlation(fill(c), F.col(target).cast("double")).alias(f"{c}__r") for c in columns]).first()
    strength = lambda c: 0.0 if (r := second[f"{c}__r"]) is None or r != r else abs(r)
    chosen = tuple(columns) if select is None or select >= len(columns) else tuple(sorted(columns, key=lambda c: (-strength(c), c))[:select])
    return Preprocessor(tuple(columns), chosen, medians, means, scales, standardise)


@dataclass(frozen=True)
class Linear:
    """A linear or logistic model as numbers."""

    columns: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    kind: str = "regression"

    def predict(self) -> Column:
        score = F.lit(self.intercept)
        for c, w in zip(self.columns, self.coefficients, strict=True):
            score = score + F.col(c) * w
        if self.kind == "classification":
            return 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), score))))
        return score


def fit_ridge(df: DataFrame, columns: Sequence[str], target: str, alpha: float) -> Linear:
    """Ridge by normal equations: the cross products are one aggregate, the solve is on the driver."""
    x = [F.col(c) for c in columns]
    n = len(x)
    sums = [F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)], F.avg(target).alias("my")]
    sums += [F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}") for i in range(n) for j in range(i, n)] + [F.covar_pop(x[i], F.col(target)).alias(f"y{i}") for i in range(n)]
    r = df.agg(*sums).first()
    gram = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] for j in range(n)] for i in range(n)]) * r.n + alpha * np.eye(n)
    beta = np.linalg.solve(gram, np.array([r[f"y{i}"] for i in range(n)]) * r.n)
    return Linear(tuple(columns), tuple(map(float, beta)), float(r.my - sum(b * r[f"m{i}"] for i, b in enumerate(beta))))


def fit_linear(df: DataFrame, columns: Sequence[str], target: str, model: str, **parameters) -> Linear:
    """elastic_net and huber regression or logistic classification by Spark's own solvers.

    Logistic regression does not penalise its intercept. Boosted trees: :func:`fit_boosted`.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    data = VectorAssembler(inputCols=list(columns), outputCol="__x").transform(df.withColumn("__y", F.col(target).cast("double"))).select("__x", "__y")
    common = {"featuresCol": "__x", "labelCol": "__y", "standardization": False}
    if model == "elastic_net":
        fitted = LinearRegression(**common, regParam=parameters.get("alpha", 1.0), elasticNetParam=parameters.get("l1_ratio", 0.5)).fit(data)
    elif model == "huber":
        fitted = LinearRegression(**common, loss="huber", epsilon=parameters.get("epsilon", 1.35), regParam=parameters.get("alpha", 0.0001)).fit(data)
    elif model == "logistic":
        fitted = LogisticRegression(**common, regParam=parameters.get("alpha", 1.0)).fit(data)
    else:
        raise ContractError(f"no model {model}")
    return Linear(tuple(columns), tuple(map(float, fitted.coefficients)), float(fitted.intercept), "classification" if model == "logistic" else "regression")


def fit_boosted(df: DataFrame, columns: Sequence[str], target: str, classification: bool = False, trees: int = 20, depth: int = 3, seed: int = 7):
    """Gradient-boosted trees; returns a function from a frame to one with ``prediction``."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    gather = VectorAssembler(inputCols=list(columns), outputCol="__x")
    kind = GBTClassifier if classification else GBTRegressor
    fitted = kind(featuresCol="__x", labelCol="__y", maxIter=trees, maxDepth=depth, seed=seed).fit(gather.transform(df.withColumn("__y", F.col(target).cast("double"))))
    return lambda frame: fitted.transform(gather.transform(frame)).drop("__x", "rawPrediction", "probability")


#: Scores; greater is better.
SCORES = {
    "neg_mean_squared_error": lambda y, p: -F.avg((y - p) * (y - p)),
    "neg_mean_absolute_error": lambda y, p: -F.avg(F.abs(y - p)),
    "accuracy": lambda y, p: F.avg(((p >= 0.5) == (y >= 0.5)).cast("double")),
}


def fold_scores(predictions: DataFrame, keys: Sequence[str], objective: str, target: str = "target", prediction: str = "prediction") -> DataFrame:
    if objective not in SCORES:
        raise ContractError(f"no objective {objective}")
    return predictions.groupBy(*keys).agg(SCORES[objective](F.col(target).cast("double"), F.col(prediction)).alias("score"), F.count(F.lit(1)).alias("rows"))


def candidate_scores(scores: DataFrame, candidate: str) -> DataFrame:
    return scores.groupBy(candidate).agg(F.avg("score").alias("mean_score"), F.count(F.lit(1)).alias("folds"))


def locked_holdout(development: DataFrame, holdout: DataFrame, columns: Sequence[str], target: str, alpha: float, objective: str, ledger) -> DataFrame:
    """Refit on development rows and score the holdout once; the ledger refuses a second time."""
    ledger.advance("opened", objective=objective)
    prepared = fit_preprocessor(development, columns, target)
    model = fit_ridge(prepared.transform(development, [target]), prepared.selected, target, alpha)
    scored = prepared.transform(holdout, [target]).withColumn("prediction", model.predict())
    out = fold_scores(scored, [], objective, target)
    ledger.advance("closed")
    return out
