"""Families of tests, minute studies, budgets, aliases, universes, declared code and streams by hand."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_simulation import POLICY, bars, fails, targets
from tidemark.errors import ContractError
from tidemark.operators import causal, checks, pit, quality, simulation, statistics, universe
from tidemark.plans import declare
from tidemark.sources import store
from tidemark.sources.tables import view_shape
from tidemark.streaming import flows

def stream(spark, tmp_path, rows, schema, build, parts):
    """Rows in order, a part in each micro-batch, through a flow that is started and stopped after each."""
    source, out, size = f"{tmp_path}/in", f"{tmp_path}/out", -(-len(rows) // parts)
    for k in range(parts):
        spark.createDataFrame(rows[k * size : (k + 1) * size], schema).coalesce(1).write.mode("append").parquet(source)
        df = build(spark.readStream.schema(schema).parquet(source))
        flows.start(df, out, f"{tmp_path}/c").awaitTermination(120)
    return spark.read.schema(df.schema).parquet(out)


FAMILY = statistics.Family("f", ("a", "b", "c"), "mean")


def test_a_family_is_adjusted_whole(spark):
    rows = spark.createDataFrame([("a", 0.01), ("b", 0.02), ("c", 0.9)], "c string, p double")
    assert [(r.c, round(r.adjusted_p, 6), r.passes_alpha) for r in FAMILY.adjust(rows, "c", "p", "holm").orderBy("c").collect()] == [("a", 0.03, True), ("b", 0.04, True), ("c", 0.9, False)]
    for bad in (rows.where("c <> 'b'"), rows.unionAll(rows.limit(1)), rows.withColumn("p", F.col("p") + 1), rows.withColumn("c", F.concat("c", F.lit("x")))):
        assert "complete for the family" in fails(FAMILY.adjust(bad, "c", "p", "holm"))
    for bad in ({"candidates": ()}, {"candidates": ("a", "a")}, {"alpha": 1.0}, {"direction": "up"}, {"name": " "}):
        with pytest.raises(ContractError):
            statistics.Family(**{"name": "f", "candidates": ("a",), "metric": "m"} | bad)
    assert FAMILY.fingerprint != statistics.Family("f", ("a", "c", "b"), "mean").fingerprint


def test_inference_intervals(spark):
    out = statistics.inference(spark.createDataFrame([(1.0, 0.5)], "estimate double, standard_error double")).first()
    assert (out.confidence_low, out.confidence_high) == (pytest.approx(1 - 1.959964 * 0.5, abs=1e-6), pytest.approx(1 + 1.959964 * 0.5, abs=1e-6))
    assert out.p_value == pytest.approx(math.erfc(2 / math.sqrt(2)))
    assert "not positive" in fails(statistics.inference(spark.createDataFrame([(1.0, 0.0)], "estimate double, standard_error double")))


def test_a_minute_study(spark):
    rng = random.Random(1)
    rows = [(c, n, n * 10, n * 10 + 25, rng.gauss(0.5 if c == "a" else 0, 1)) for c in ("a", "b") for n in range(120)]
    labels = spark.createDataFrame(rows, "candidate string, observation_id int, entry int, exit int, value double")
    profile = statistics.MinuteProfile(FAMILY, 200, 400, 1200, 25, 2)
    trials, report = statistics.minute_statistics(labels, profile)
    got = {r.candidate: r for r in trials.collect()}
    test = [v for c, n, a, b, v in rows if c == "a" and 425 <= a < 1200 and b <= 1200]
    assert got["a"].sample_count == len(test) and got["a"].estimate == pytest.approx(sum(test) / len(test))
    assert got["a"].raw_p < 0.01 < got["b"].raw_p and (got["c"].sample_count, got["c"].raw_p, got["c"].estimate) == (0, 1.0, None)
    assert tuple(report.first()) == (2, 25, "search.minute_trial_universe_incomplete,statistics.minute_sample_invalid", "fail")
    assert statistics.minute_validity(trials, labels, profile).collect() == []
    assert {r.check for r in statistics.minute_validity(trials.withColumn("estimate", F.col("estimate") + 0.1), labels, profile).collect()} == {"minute_estimate"}
    assert "not in the family" in fails(statistics.minute_statistics(labels.withColumn("candidate", F.lit("z")), profile)[0])


def test_candidates_more_than_periods(spark):
    rng = random.Random(2)
    rows = [(t, f"c{c}", rng.gauss(0, 1)) for t in range(6) for c in range(15)]
    df = spark.createDataFrame(rows, "t int, c string, v double")
    rho = pd.DataFrame(rows).pivot(index=0, columns=1, values=2).corr().to_numpy()
    assert statistics.effective_trials(df, "t", "c", "v").first().effective_trials == pytest.approx(225 / (rho**2).sum())


def test_a_matrix_has_a_budget(spark, monkeypatch):
    monkeypatch.setattr(statistics, "MATRIX_BYTES", 100)
    rows = spark.createDataFrame([(t, f"c{c}", 1.0) for t in range(5) for c in range(5)], "t int, c string, v double")
    with pytest.raises(ContractError):
        statistics.matrix_of(rows, "t", "c", "v")


def test_budgets_of_rows_and_bytes(spark, tmp_path):
    spark.range(1000).withColumn("s", F.lit("x" * 10)).write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    assert quality.preflight(rows)["bytes"] > 0
    with pytest.raises(ContractError):
        quality.preflight(rows, max_bytes=10)
    assert quality.within_budget(rows, 1000, 18_000).count() == 1000
    assert "pass the budget" in fails(quality.within_budget(rows, 999, 18_000)) and "pass the budget" in fails(quality.within_budget(rows, 1000, 17_999))
    assert quality.concatenate([rows, rows.select("s", "id")], 1 << 20).count() == 2000
    with pytest.raises(ContractError):
        quality.concatenate([rows, rows.select("id")], 1 << 20)


def test_aliases(spark):
    rows = spark.createDataFrame([("x", 5), ("x", 10), ("x", 11)], "alias string, day int")
    names = spark.createDataFrame([("x", "one", 1, 10), ("x", "two", 11, None)], "alias string, instrument string, start int, end int")
    assert sorted((r.day, r.instrument) for r in pit.resolve_alias(rows, names, "alias", "day").collect()) == [(5, "one"), (10, "one"), (11, "two")]
    for bad in (names.limit(1), names.unionAll(spark.createDataFrame([("x", "three", 5, 5)], names.schema))):
        assert "names no instrument" in fails(pit.resolve_alias(rows, bad, "alias", "day"))


def test_universe_plans(spark):
    step = universe.Step
    base = step("b", "base", ("d",))
    for bad in (
        (base, step("b", "base", ("d",))), (step("f", "filter", ("q",), ("a", "is_true")),), (step("u", "union", ("b",)), base), (step("x", "none", ()),),
        (step("f", "filter", ("g",), ()), step("g", "filter", ("f",), ())), (base, step("c", "base", ("d",))), (base, step("a", "as_of", ("b",), ("1999",))),
    ):
        with pytest.raises(ContractError):
            universe.compile_steps(bad, ("d",), "1998")
    order = universe.compile_steps((step("a", "as_of", ("b",), ("1998",)), base), ("d",), "1998")
    assert [s.name for s in order] == ["b", "a"]
    rows = spark.createDataFrame([("i", False, "no_row", None)], "instrument string, included boolean, reason string, attributes map<string,string>")
    assert "is empty" in fails(universe.evaluate((base,), {"d": rows}, "1998"))


def test_metrics_are_decoded(spark):
    rows = spark.createDataFrame([("m", 1.0, 3)], "metric_ref string, value double, sample_size int")
    assert [tuple(r) for r in causal.decode_metrics(rows, ["m"]).collect()] == [("m", 1.0, 3)]
    for bad in (rows.unionAll(rows), rows.withColumn("value", F.lit(float("nan"))), rows.withColumn("sample_size", F.lit(0)), rows.withColumn("metric_ref", F.lit("z"))):
        assert "a metric is" in fails(causal.decode_metrics(bad, ["m"]))


def test_no_later_fact_is_visible(spark):
    decisions = spark.createDataFrame([("k", 1, 5), ("k", 2, 9), ("z", 3, 9)], "key string, id int, at int")
    facts = spark.createDataFrame([("k", 5, 1.0), ("k", 6, 2.0), ("k", 10, 3.0)], "key string, known int, v double")
    out = {r.id: r for r in causal.visible_to(decisions, facts, ["key"], "at", "known").collect()}
    assert [(out[i].facts_read, out[i].last_available, [f.v for f in out[i].facts]) for i in (1, 2, 3)] == [(1, 5, [1.0]), (2, 6, [1.0, 2.0]), (0, None, [])]


def test_shapes_of_views(spark):
    assert [view_shape(spark, x) for x in ("select a from t where a > 1", "select a from t union all select b from u", "select 1 from t join u using (a)", "select * from parquet.`/p`")] == ["projection", "union_all", "join", "parquet"]
    for bad in ("select a from t union select b from u", "select t.a from t join u using (a) union all select a from v", "select distinct a from t", "select a, count(*) from t group by a"):
        with pytest.raises(ContractError):
            view_shape(spark, bad)


def test_bundles(spark):
    a, b = spark.range(3), spark.range(4)
    both = store.Bundle({"a": a}).merge(store.Bundle({"b": b}), store.Bundle({"a": a}))
    assert sorted(both.frames) == ["a", "b"] and both.select("b").frames["b"].count() == 4
    with pytest.raises(ContractError):
        both.merge(store.Bundle({"a": b}))
    with pytest.raises(ContractError):
        both.select("c")


def test_months_have_receipts(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2024, 1), (2, 2024, 1), (3, 2024, 2)], "k int, year int, month int")
    rows.write.partitionBy("year", "month").parquet(f"{tmp_path}/m")
    receipts = {}
    for month in (1, 2):
        receipts[2024, month] = quality.content_fingerprint(spark.read.parquet(f"{tmp_path}/m").where(f"month = {month}").select("k")).first().asDict()
    assert store.verified_months(spark, f"{tmp_path}/m", receipts, ["k"]).count() == 3
    for bad in ({**receipts, (2024, 2): {**receipts[2024, 2], "row_count": 2}}, {(2024, 1): receipts[2024, 1]}, {**receipts, (2024, 3): receipts[2024, 1]}):
        with pytest.raises(ContractError):
            store.verified_months(spark, f"{tmp_path}/m", bad, ["k"])


def test_second_computations_and_workspaces(spark):
    rows = spark.createDataFrame([("a", 1, 2.0), ("b", 2, None)], "k string, x int, y double")
    assert checks.recomputed(rows, rows, ["k"]).collect() == []
    other = spark.createDataFrame([("a", 1, 3.0), ("c", 2, None)], rows.schema)
    assert sorted((r.check, r.key) for r in checks.recomputed(rows, other, ["k"]).collect()) == [("x", "b"), ("x", "c"), ("y", "a")]
    assert checks.Workspace({"t": rows}).sql("select sum(x) as s from {t}").first().s == 3
    assert "more than 1" in fails(checks.Workspace({"t": rows}, 1).sql("select * from {t}"))


def running_total(context, frame, state):
    total = int(state or 0) + int(frame["v"].sum())
    return pd.DataFrame({"total": [total], "seed": [context.seed % 97]}), str(total)


def test_code_over_partitions_keeps_its_state(spark, tmp_path):
    context = declare.Context("p", "r", "n", "2024-01-01T00:00:00", max_rows=3)
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    out, states = declare.states_of(declare.run_partitioned(rows, "k", running_total, "total long, seed int", context), "k")
    assert sorted((r.k, r.total, r.seed) for r in out.collect()) == [("a", 3, context.seed % 97), ("b", 5, context.seed % 97)]
    out, states = declare.states_of(declare.run_partitioned(rows.where("k = 'a'"), "k", running_total, "total long, seed int", context, states), "k")
    assert [(r.k, r.total) for r in out.collect()] == [("a", 6)] and sorted(map(tuple, states.collect())) == [("a", "6"), ("b", "5")]
    assert "partition a has 4 rows" in fails(declare.run_partitioned(rows.unionAll(rows), "k", running_total, "total long, seed int", context))


def test_what_identifies_a_run():
    assert declare.Context("p", "r", "n", "c").seed == declare.Context("p", "r", "n", "c").seed != declare.Context("p", "r", "m", "c").seed
    assert len(set(declare.seeds(7, ["a", "b", "c"]).values())) == 3 and declare.seeds(7, ["a"]) != declare.seeds(8, ["a"])
    declare.operator("for_test")(running_total)
    found = declare.descriptor("for_test")
    assert found["parameters"] == ["context", "frame", "state"] and len(found["code_hash"]) == 64
    del declare.OPERATORS["for_test"]
    assert declare.Semantics("next_open", "participation").ceiling == "executable" and declare.Semantics("same_close", "participation").ceiling == "exploratory"
    declare.Semantics("next_open", "historical_volume").require("indicative")
    with pytest.raises(ContractError):
        declare.Semantics("next_open", "unlimited").require("indicative")
    with pytest.raises(ContractError):
        declare.Semantics("never", "unlimited")


@pytest.mark.parametrize("lag", [0, 1, 3])
def test_one_pass_means_are_those_of_the_batch(spark, tmp_path, lag):
    rng = random.Random(4)
    rows = [("k", n, rng.gauss(0.2, 1)) for n in range(40)]
    schema = "k string, n int, v double"
    out = stream(spark, tmp_path, rows, schema, lambda df: flows.hac_means(df, "k", "n", "v", lag), parts=4) if lag == 3 else None
    sums = flows.HacSums(lag)
    for *_, v in rows:
        sums.add(v)
    want = statistics.hac_mean(spark.createDataFrame(rows, schema), ["k"], ["n"], "v", lag).first()
    assert sums.estimate() == (pytest.approx(want.estimate), pytest.approx(want.standard_error))
    if out is not None:
        last = max(out.collect(), key=lambda r: r.sample_size)
        assert (last.sample_size, last.estimate, last.standard_error) == (40, pytest.approx(want.estimate), pytest.approx(want.standard_error))


def test_a_streamed_simulation_is_that_of_the_batch(spark, tmp_path):
    b, t = bars(spark, [100, 101, 102, 103, 104, 105, 106]), targets(spark, (0, 1, 1500), (1, 0, 300))
    whole = sorted(map(tuple, simulation.simulate_minutes(b, t, POLICY, 1_000_000).collect()))
    events = simulation.minute_events(b, t).orderBy("time", "what", "code", "dt", "seq")
    out = stream(spark, tmp_path, [tuple(r) for r in events.collect()], events.schema, lambda df: flows.simulate_minutes(df, POLICY, 1_000_000), parts=3)
    got = sorted(map(tuple, out.collect()))
    assert got == whole[: len(got)] and len(whole) - len(got) == 1  # the last session is still open
