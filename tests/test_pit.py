"""Point-in-time selection: hand-made cases, ties, and attempts to look ahead."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators import causal, pit, query, universe
from tidemark.operators.query import Filter, Request
from tidemark.plans import examples
from tidemark.schema import Dataset, Field


def ts(text):
    return datetime.fromisoformat(text)


def clock(text):
    return F.lit(text).cast("timestamp_ntz")


def fails(df):
    with pytest.raises(Exception) as e:
        df.collect()
    return str(e.value)


FACTS = "entity string, available timestamp_ntz, revision int, value double"


def facts(spark):
    return spark.createDataFrame([("a", ts("2024-01-01"), 1, 1.0), ("a", ts("2024-01-03"), 2, 2.0), ("a", ts("2024-01-09"), 3, 9.0), ("b", ts("2024-01-02"), 1, 5.0)], FACTS)


def test_a_revision_that_was_not_visible_never_wins(spark):
    seen = facts(spark).where(pit.visible(["available"], clock("2024-01-05")))
    out = {r.entity: r.value for r in pit.revision_winner(seen, ["entity"], ["revision"]).collect()}
    assert out == {"a": 2.0, "b": 5.0}
    later = facts(spark).where(pit.visible(["available"], clock("2024-01-09")))
    assert {r.entity: r.value for r in pit.revision_winner(later, ["entity"], ["revision"]).collect()}["a"] == 9.0
    strictly = facts(spark).where(pit.visible(["available"], clock("2024-01-09"), inclusive=False))
    assert {r.entity: r.value for r in pit.revision_winner(strictly, ["entity"], ["revision"]).collect()}["a"] == 2.0


def test_a_business_filter_before_the_selection_would_change_the_winner(spark):
    winner = pit.revision_winner(facts(spark), ["entity"], ["revision"])
    assert winner.where("value < 5").count() == 0


def test_tied_winners_are_an_error_only_where_they_win(spark):
    tied = facts(spark).unionAll(facts(spark).where("revision = 1 and entity = 'a'"))
    assert pit.revision_winner(tied, ["entity"], ["revision"]).count() == 2
    tied = facts(spark).unionAll(facts(spark).where("revision = 3"))
    assert "two newest" in fails(pit.revision_winner(tied, ["entity"], ["revision"]))
    assert pit.revision_winner(tied, ["entity"], ["revision"], on_tie="first").count() == 2


def test_intervals_are_half_open_and_may_not_overlap(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 5, None), ("b", 3, 4)], "e string, s int, t int")
    at = lambda n: sorted((r.e, r.s) for r in pit.effective_rows(rows, ["e"], "s", "t", F.lit(n)).collect())
    assert at(5) == [("a", 5)] and at(4) == [("a", 1)] and at(3) == [("a", 1), ("b", 3)]
    both = rows.unionAll(spark.createDataFrame([("a", 4, 9)], "e string, s int, t int"))
    assert "in force" in fails(pit.effective_rows(both, ["e"], "s", "t", F.lit(4)))


def test_asof_join_takes_the_latest_at_or_before(spark):
    left = spark.createDataFrame([(1, "a", 10), (2, "a", 3), (3, "b", 10), (4, None, 10), (5, "a", None), (1, "a", 10)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 5, 50), ("a", 10, 100), ("a", 11, 110), (None, 1, 1), ("a", 10, 99)], "k string, t int, v int")
    out = sorted([(r.id, r.v) for r in pit.asof_join(left, right, ["k"], "t", "t", ["v"]).collect()], key=str)
    assert out == sorted([(1, 100), (1, 100), (2, None), (3, None), (4, None), (5, None)], key=str)
    before = pit.asof_join(left, right, ["k"], "t", "t", ["v"], how="inner", inclusive=False).collect()
    assert sorted((r.id, r.v) for r in before) == [(1, 50), (1, 50)]


def test_latest_revision_needs_both_times(spark):
    rows = spark.createDataFrame([("a", 1, 1, 10.0), ("a", 2, 9, 20.0), ("a", 9, 2, 30.0)], "e string, available int, revision int, v double")
    assert [r.v for r in pit.latest_revision(rows, ["e"], "available", "revision", F.lit(5)).collect()] == [10.0]


def test_merges_have_to_close(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (2, "q")], "k int, b string")
    assert pit.one_to_one(a, b, ["k"]).count() == 2
    assert "differ" in fails(pit.one_to_one(a, b.where("k = 1"), ["k"]))
    assert "differ" in fails(pit.one_to_one(a.unionAll(a.where("k = 1")), b, ["k"]))


def test_features_may_not_look_ahead_and_labels_not_back(spark):
    rows = spark.createDataFrame([(1, 5, 4, 5, "p"), (1, 5, 3, 4, "q")], "k int, d int, o int, a int, part string")
    out = causal.require_known(causal.feature_time_facts(rows, ["k"], "d", "o", "a", "part")).collect()[0]
    assert (out.max_observation_time, out.max_available_time, out.source_partition_ids) == (4, 5, ["p", "q"])
    late = rows.unionAll(spark.createDataFrame([(1, 5, 5, 6, "r")], rows.schema))
    assert "looks ahead" in fails(causal.require_known(causal.feature_time_facts(late, ["k"], "d", "o", "a", "part")))
    two = rows.unionAll(spark.createDataFrame([(1, 6, 4, 4, "r")], rows.schema))
    assert "two decision" in fails(causal.feature_time_facts(two, ["k"], "d", "o", "a", "part"))
    labels = spark.createDataFrame([(5, 6, 7, 7)], "d int, f int, l int, a int")
    assert causal.require_future(labels, "d", "f", "l", "a").count() == 1
    assert "after its decision" in fails(causal.require_future(labels.withColumn("f", F.lit(5)), "d", "f", "l", "a"))


PANEL = [("A", 1, 11.0), ("A", 2, 12.0), ("A", 3, 12.3), ("B", 1, 10.0), ("B", 2, 10.1), ("B", 3, 10.0), ("C", 1, 10.0), ("C", 2, 9.0), ("C", 3, 8.8), ("D", 1, 10.0), ("D", 2, 10.5), ("D", 3, 10.6)]


def panel(spark, late=()):
    rows = [(i, date(2024, 1, 2 + s), p, p, datetime(2024, 1, 3 + s, 0, 0) if (i, s) not in late else datetime(2024, 2, 1)) for i, s, p in PANEL]
    return spark.createDataFrame(rows, "instrument string, session date, open double, close double, available_at timestamp_ntz")


def study(df):
    return examples.cross_section(df, date(2024, 1, 3), date(2024, 1, 4), date(2024, 1, 5), clock("2024-01-05 09:30:00"))


def test_cross_section_ranks_what_was_known(spark):
    out = {r.instrument: r for r in study(panel(spark)).collect()}
    assert sorted(out, key=lambda i: out[i].position) == ["A", "D", "B", "C"]
    assert out["A"].signal == pytest.approx(12 / 11 - 1) and out["A"].outcome == pytest.approx(12.3 / 12 - 1)
    assert out["A"].spread == pytest.approx((12.3 / 12 - 1) - (8.8 / 9 - 1))
    assert "A" not in {r.instrument for r in study(panel(spark, late=[("A", 2)])).collect()}
    early = panel(spark).withColumn("available_at", F.when(F.col("session") == F.lit(date(2024, 1, 5)), F.lit("2024-01-05 01:00:00").cast("timestamp_ntz")).otherwise(F.col("available_at")))
    assert "known at the decision" in fails(study(early))


def test_events_are_spaced_and_revised_as_seen(spark):
    rows = [("E1", "a", date(2024, 1, 2), 1, 0.1, ts("2024-01-02"), ts("2024-01-02")), ("E1", "a", date(2024, 1, 2), 2, 9.9, ts("2024-01-05"), ts("2024-01-02")), ("E2", "a", date(2024, 1, 3), 1, 0.2, ts("2024-01-03"), ts("2024-01-03")), ("E3", "a", date(2024, 1, 4), 1, 0.3, ts("2024-01-04"), ts("2024-01-04"))]
    events = spark.createDataFrame(rows, "event_id string, instrument string, event_day date, revision int, surprise double, available_at timestamp_ntz, decision_at timestamp_ntz")
    prices = spark.createDataFrame([("a", date(2024, 1, d), p) for d, p in ((2, 10.0), (3, 10.5), (4, 10.0), (5, 11.0))], "instrument string, session date, close double")
    out = {r.event_id: r for r in examples.event_study(events, prices, 2).collect()}
    assert set(out) == {"E1", "E3"} and out["E1"].revision == 1 and out["E1"].window_return == pytest.approx(0.05)


def test_term_structure(spark):
    rows = [("p", "c2", date(2024, 2, 15), 100.0, 5), ("p", "c3", date(2024, 3, 15), 103.0, 5), ("p", "c1", date(2024, 1, 10), 99.0, 5), ("p", "c9", date(2024, 2, 20), 1.0, 0)]
    contracts = spark.createDataFrame(rows, "product string, contract string, expiry date, settlement double, volume int").withColumn("observation_day", F.lit(date(2024, 1, 15)))
    r = examples.term_structure(contracts, "product").collect()[0]
    assert (r.near, r.deferred, r.signal) == ("c2", "c3", "carry_short") and r.annualized_slope == pytest.approx(0.03 * 365 / 29)


def test_universe_decisions_carry_reasons(spark):
    members = spark.createDataFrame([(k,) for k in "abcd"], "i string")
    rows = spark.createDataFrame([("a", 1, 1, None, "x", "true"), ("b", 9, 1, None, "x", "true"), ("c", 1, 1, 2, "y", "false"), ("e", 1, 1, None, "z", "true")], "i string, available int, s int, t int, sector string, ok string")
    u = universe.base(members, rows, "i", "available", "s", "t", F.lit(5), ("sector", "ok"))
    assert {r.instrument: r.reason for r in u.collect()} == {"a": "included", "b": "not_visible", "c": "not_effective", "d": "no_row"}
    assert {r.instrument for r in universe.filtered(u, "ok", "is_true").where("included").collect()} == {"a"}
    assert universe.filtered(u, "ok", "is_false").where("included").count() == 0
    assert "no attribute" in fails(universe.filtered(u, "size", "eq", "1"))
    empty = universe.filtered(u, "sector", "eq", "q")
    assert "empty" in fails(universe.require_members(empty))
    clash = u.withColumn("attributes", F.create_map(F.lit("sector"), F.lit("other")))
    assert "attribute differs" in fails(universe.union(u, clash))
    twice = rows.unionAll(rows.where("i = 'a'"))
    assert "in force" in fails(universe.base(members, twice, "i", "available", "s", "t", F.lit(5)))


SET = Dataset("d", (Field("k", "integer", "kk"), Field("v", "number")), key=("k",))


def test_requests_are_checked_before_they_run(spark):
    source = spark.createDataFrame([(k, float(k)) for k in range(10)], "kk int, v double")
    with pytest.raises(ContractError):
        Request(SET, ("v",)).plan(source)
    with pytest.raises(ContractError):
        Request(SET, ("k", "w")).plan(source)
    with pytest.raises(ContractError):
        Request(SET, ("k",), order=(("v", "asc"),)).plan(source)
    for bad in (("v", "like", (1,)), ("v", "eq", ()), ("v", "eq", (None,)), ("v", "range", (3, 1)), ("v", "in", ()), ("v", "is_null", (1,))):
        with pytest.raises(ContractError):
            Filter(*bad)
    assert Request(SET, ("k",), max_rows=10).plan(source).count() == 10
    assert "more than 9" in fails(Request(SET, ("k",), max_rows=9).plan(source))


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id as kk", "cast(id as double) v", "'x' as other").write.parquet(f"{tmp_path}/t")
    plan = Request(SET, ("k",), filters=(Filter("k", "range", (3, 5)),)).plan(spark.read.parquet(f"{tmp_path}/t"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(kk), GreaterThanOrEqual(kk,3), LessThanOrEqual(kk,5)]" in text
    assert "ReadSchema: struct<kk:bigint>" in text


def test_clocks():
    assert query.wall_clock("2024-01-05T09:30:00+08:00", "Asia/Shanghai") == datetime(2024, 1, 5, 9, 30)
    assert query.cutoff(date(2024, 1, 5)) == datetime(2024, 1, 6) and query.cutoff(datetime(2024, 1, 5, 3)) == datetime(2024, 1, 5, 3)
    with pytest.raises(ContractError):
        query.wall_clock("2024-01-05T09:30:00", "UTC")
    assert causal.causal_key(["code", "date", "x"]) == ("date", "code")
