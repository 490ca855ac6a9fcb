"""Statistics against numpy, splits and models by hand."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators import modeling, statistics, validation


@pytest.fixture(scope="module")
def series():
    return np.random.default_rng(3).normal(0.01, 0.05, 60)


def frame(spark, x):
    return spark.createDataFrame([(1, k, float(v)) for k, v in enumerate(x)], "g int, t int, v double")


def test_hac_mean(spark, series):
    r = statistics.hac_mean(frame(spark, series), ["g"], ["t"], "v", 3).collect()[0]
    c, n = series - series.mean(), len(series)
    total = c @ c / n + sum(2 * (1 - k / 4) * (c[k:] @ c[:-k]) / n for k in (1, 2, 3))
    assert r.standard_error == pytest.approx(math.sqrt(total / n)) and r.estimate == pytest.approx(series.mean())


def test_overlap_lag(spark):
    rows = spark.createDataFrame([(1, 0, 5), (1, 2, 4), (1, 3, 9), (1, 4, 6), (2, 0, 1), (2, 1, 2)], "g int, s int, e int")
    assert {r.g: r.overlap_lag for r in statistics.overlap_lag(rows, ["g"], "s", "e").collect()} == {1: 3, 2: 0}


def test_adjusted_p_values(spark):
    p = [0.01, 0.04, 0.03, 0.5]
    rows = spark.createDataFrame([(1, k, v) for k, v in enumerate(p)], "f int, c int, p double")
    run = lambda m: [r.adjusted_p for r in statistics.adjust_p(rows, ["f"], "p", "c", m, independent=True).orderBy("c").collect()]
    assert run("bonferroni") == pytest.approx([0.04, 0.16, 0.12, 1.0])
    assert run("holm") == pytest.approx([0.04, 0.09, 0.09, 0.5])
    assert run("benjamini_hochberg") == pytest.approx([0.04, 0.16 / 3, 0.16 / 3, 0.5])
    assert run("benjamini_yekutieli") == pytest.approx([min(1, x * 25 / 12) for x in (0.04, 0.16 / 3, 0.16 / 3, 0.5)])
    with pytest.raises(ContractError):
        statistics.adjust_p(rows, ["f"], "p", "c", "benjamini_hochberg")


def test_probabilistic_sharpe(spark, series):
    r = statistics.probabilistic_sharpe(frame(spark, series), ["g"], "v").collect()[0]
    s, z = series.mean() / series.std(ddof=1), (series - series.mean()) / series.std(ddof=1)
    score = s * math.sqrt(len(series) - 1) / math.sqrt(1 - (z**3).mean() * s + ((z**4).mean() - 1) / 4 * s * s)
    assert r.probability == pytest.approx(0.5 * math.erfc(-score / math.sqrt(2)))


def matrix(spark, n=40, k=5, seed=1):
    x = np.random.default_rng(seed).normal(0, 1, (n, k))
    x[:, 1] = x[:, 0] * 0.9 + x[:, 1] * 0.1
    return x, spark.createDataFrame([(t, f"c{j}", float(x[t, j])) for t in range(n) for j in range(k)], "t int, c string, v double")


def test_effective_trials_and_deflated_sharpe(spark):
    x, rows = matrix(spark)
    rho = np.corrcoef(x.T)
    want = 25 / (rho**2).sum()
    assert statistics.effective_trials(rows, "t", "c", "v").first().effective_trials == pytest.approx(want)
    out = statistics.deflated_sharpe(rows, "t", "c", "v", "c2")
    assert out["effective_trials"] == pytest.approx(want) and 0 < out["probability"] < 1 and out["benchmark"] > 0


def test_overfitting_probability(spark):
    from itertools import combinations

    x, rows = matrix(spark, n=6, k=4, seed=5)
    low = 0
    halves = list(combinations(range(6), 3))
    for half in halves:
        rest = [i for i in range(6) if i not in half]
        best = int(np.argmax(x[list(half)].mean(axis=0)))
        rank = int((x[rest].mean(axis=0) < x[rest].mean(axis=0)[best]).sum()) + 1
        low += (rank - 0.5) / 4 <= 0.5
    r = statistics.overfitting_probability(rows, "t", "c", "v").first()
    assert (r.combinations, r.probability) == (20, pytest.approx(low / 20))


def test_bootstrap_blocks():
    for k in range(20):
        at = statistics.bootstrap_indices("moving_block", 23, 5, 1, k)
        assert len(at) == 23 and all((at[j + 1] - at[j]) % 23 == 1 for j in range(22) if (j + 1) % 5)
    steps = np.concatenate([np.diff(statistics.bootstrap_indices("stationary", 200, 8, 1, k)) % 200 for k in range(50)])
    assert 0.82 < (steps == 1).mean() < 0.92
    assert statistics.bootstrap_indices("stationary", 50, 5, 1, 2).tolist() == statistics.bootstrap_indices("stationary", 50, 5, 1, 2).tolist()


def test_reality_check_sees_a_real_edge(spark):
    x, rows = matrix(spark, n=60, k=4)
    strong = rows.withColumn("v", F.when(F.col("c") == "c3", F.col("v") + 2).otherwise(F.col("v")))
    for method in ("white", "spa"):
        assert statistics.reality_check(strong, "t", "c", "v", method, replications=200).first().p_value < 0.05
        assert statistics.reality_check(rows, "t", "c", "v", method, replications=200).first().p_value > 0.05


def test_result_statistics_start_the_peak_at_one(spark):
    rows = spark.createDataFrame([(1, f"2024-01-0{k + 1}", v) for k, v in enumerate([-0.1, 0.2, 0.0, -0.5])], "g int, d string, v double")
    r = statistics.result_statistics(rows, ["g"], "d", "v", "simple_return", 252).collect()[0]
    assert r.max_drawdown == pytest.approx(0.54 / 1.08 - 1) and r.compounded_return == pytest.approx(-0.46)
    assert (r.positive_count, r.negative_count, r.zero_count, r.best_date, r.worst_date) == (1, 2, 1, "2024-01-02", "2024-01-04")
    first = statistics.result_statistics(rows.where("v = -0.1"), ["g"], "d", "v", "simple_return").collect()[0]
    assert first.max_drawdown == pytest.approx(-0.1)


def samples(spark, n=12):
    day = lambda k: datetime(2024, 1, 1) + timedelta(days=k)
    return spark.createDataFrame([(k, day(k), day(k), day(k + 1), day(k + 2), day(k + 2)) for k in range(n)], "sample_id int, observation_time timestamp_ntz, decision_time timestamp_ntz, label_start timestamp_ntz, label_end timestamp_ntz, label_available timestamp_ntz")


def calendar(spark, n=14):
    return spark.createDataFrame([((datetime(2024, 1, 1) + timedelta(days=k)).date(),) for k in range(n)], "session date")


def test_purged_folds(spark):
    out = {(r.fold, r.sample_id): r.role for r in validation.purged_kfold(samples(spark), calendar(spark), 3, 2).collect()}
    assert len(out) == 36
    assert [out[2, k] for k in range(12)] == ["train", "train", "purged", "purged", "validation", "validation", "validation", "validation", "embargoed", "embargoed", "train", "train"]
    uneven = {r.sample_id: r.fold for r in validation.fold_blocks(samples(spark, 11), 4).collect()}
    assert [uneven[k] for k in range(11)] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4]


def test_walk_forward_purges_labels_not_yet_known(spark):
    out = {(r.fold, r.sample_id): r.role for r in validation.walk_forward(samples(spark), calendar(spark, 12), 4, 3, 2, 3, 1, True).collect()}
    assert [out.get((1, k)) for k in range(11)] == ["train", "train", "purged", "purged", "validation", "validation", "purged", "embargoed", "test", "test", None]
    assert {f for f, _ in out} == {1}
    rolling = validation.walk_forward(samples(spark), calendar(spark, 12), 3, 2, 1, 2, 0, False)
    assert min(r.sample_id for r in rolling.where("fold = 2").collect()) == 2


def test_ledgers_of_trials_and_holdouts(spark, tmp_path):
    events = spark.createDataFrame([("a", 1, "started"), ("a", 2, "completed"), ("b", 1, "completed")], "trial string, seq int, event string")
    assert validation.trial_states(events.where("trial = 'a'")).collect()[0].state == "completed"
    with pytest.raises(Exception, match="out of order"):
        validation.trial_states(events).collect()
    held = validation.HoldoutLedger(str(tmp_path), "h")
    for state in ("frozen", "prepared"):
        held.advance(state)
    rows = spark.createDataFrame([(float(k), float(2 * k)) for k in range(20)], "x double, target double")
    assert modeling.locked_holdout(rows.where("x < 15"), rows.where("x >= 15"), ["x"], "target", 1e-9, "neg_mean_squared_error", held).first().score == pytest.approx(0, abs=1e-9)
    with pytest.raises(ContractError):
        held.advance("opened")


def test_preprocessing_and_ridge(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 3))
    y = x @ [1.0, -2.0, 0.0] + 0.5 + rng.normal(size=80) * 0.01
    rows = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)], "a double, b double, c double, target double")
    fitted = modeling.fit_ridge(rows, ["a", "b", "c"], "target", 3.0)
    xc, yc = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 3 * np.eye(3), xc.T @ yc)
    assert fitted.coefficients == pytest.approx(want) and fitted.intercept == pytest.approx(y.mean() - want @ x.mean(axis=0))
    p = modeling.fit_preprocessor(rows.withColumn("a", F.when(F.col("a") < 1, F.col("a"))).withColumn("k", F.lit(7.0)), ["a", "b", "c", "k"], select=2)
    assert p.selected[0] == "b" and p.scales["k"] == 1.0
    assert p.medians["a"] == pytest.approx(np.median(x[:, 0][x[:, 0] < 1]))
    for model in ("elastic_net", "huber"):
        got = modeling.fit_linear(rows, ["a", "b", "c"], "target", model, alpha=0.0001)
        assert got.coefficients == pytest.approx([1, -2, 0], abs=0.02)
    marked = rows.withColumn("target", (F.col("target") > 0).cast("double"))
    logistic = modeling.fit_linear(marked, ["a", "b", "c"], "target", "logistic", alpha=0.001)
    scored = marked.withColumn("prediction", logistic.predict())
    assert modeling.fold_scores(scored, [], "accuracy").first().score > 0.95
    boosted = modeling.fit_boosted(rows, ["a", "b"], "target", trees=5)(rows)
    assert modeling.fold_scores(boosted, [], "neg_mean_squared_error").first().score > -1.5
