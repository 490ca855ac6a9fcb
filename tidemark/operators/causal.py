"""Causal time of features and labels: what was known when, with the proofs as guards."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import ContractError
from tidemark.operators.pit import guard, one_to_one

#: Key columns a table of samples may be identified by, in order of choice.
KEYS = (("date", "code"), ("instrument", "bar_end"), ("entity_id", "observation_session"), ("event_id", "relative_session"), ("event_id",))


def causal_key(columns: Sequence[str]) -> tuple[str, ...]:
    """The first of the known keys whose columns are all there."""
    for key in KEYS:
        if set(key) <= set(columns):
            return key
    raise ContractError("no causal key among the columns")


def feature_time_facts(sources: DataFrame, key: Sequence[str], decision: str, observed: str, available: str, partition: str) -> DataFrame:
    """Per feature row: its one decision time, the latest observation and availability, its partitions."""
    facts = sources.groupBy(*key).agg(
        F.min(decision).alias("decision_time"), F.max(decision).alias("__other"), F.max(observed).alias("max_observation_time"), F.max(available).alias("max_available_time"), F.array_sort(F.collect_set(partition)).alias("source_partition_ids")
    )
    return facts.where(guard(F.col("decision_time") == F.col("__other"), "a feature row has two decision times")).drop("__other")


def require_known(facts: DataFrame) -> DataFrame:
    """Raise if a feature uses what was observed or available only after its decision."""
    known = (F.col("max_observation_time") <= F.col("decision_time")) & (F.col("max_available_time") <= F.col("decision_time"))
    return facts.where(guard(F.coalesce(known, F.lit(False)), "a feature looks ahead of its decision"))


def require_future(labels: DataFrame, decision: str, first: str, last: str, available: str) -> DataFrame:
    """Raise unless decision < first <= last <= available for every label."""
    later = (F.col(first) > F.col(decision)) & (F.col(last) >= F.col(first)) & (F.col(available) >= F.col(last))
    return labels.where(guard(F.coalesce(later, F.lit(False)), "a label does not lie after its decision"))


def attach_facts(rows: DataFrame, facts: DataFrame, key: Sequence[str]) -> DataFrame:
    """One-to-one merge; a key that only one side has is an error."""
    return one_to_one(rows, facts, key)


def window_rules(rows: DataFrame, feature_end: str, observation: str, label_start: str, label_end: str, available: str) -> DataFrame:
    """feature window <= observation <= label start <= label end <= availability."""
    order = [feature_end, observation, label_start, label_end, available]
    sound = reduce(and_, [F.col(a) <= F.col(b) for a, b in zip(order, order[1:], strict=False)])
    return rows.where(guard(F.coalesce(sound, F.lit(False)), "feature and label windows are out of order"))


def completed_bar_trace(bars: DataFrame, start: str, end: str, available: str | None = None) -> DataFrame:
    """event = bar start, observation = bar end, availability = its own or the bar end; in that order."""
    seen = F.col(available) if available else F.col(end)
    rows = bars.withColumn("event_time", F.col(start)).withColumn("observation_time", F.col(end)).withColumn("available_time", F.coalesce(seen, F.col(end)))
    return rows.where(guard((F.col("event_time") < F.col("observation_time")) & (F.col("observation_time") <= F.col("available_time")), "a bar is visible before it is complete"))


def next_open_trace(sessions: DataFrame, date: str) -> DataFrame:
    """Decide at a session's close (15:00), order at 09:25 and fill at 09:30 of the next session."""
    w = Window.orderBy(date)  # a calendar: one row a day
    nxt = F.lead(date).over(w)
    at = lambda d, h, m: F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), F.lit(h), F.lit(m), F.lit(0))
    rows = sessions.select(date).distinct().withColumn("next_session", nxt).where("next_session is not null")
    return rows.select(date, at(F.col(date), 15, 0).alias("decision_time"), at(F.col("next_session"), 9, 25).alias("order_time"), at(F.col("next_session"), 9, 30).alias("fill_time"))


def session_at_offset(sessions: DataFrame, date: str, offset: int, name: str) -> DataFrame:
    """The session ``offset`` places on in the calendar; null beyond its ends."""
    w = Window.orderBy(date)  # a calendar: one row a day
    return sessions.select(date).distinct().withColumn(name, F.lead(date, offset).over(w) if offset >= 0 else F.lag(date, -offset).over(w))


def statement_visible(facts: DataFrame, published: str, revised: str, as_of, trailing: str | None = None, transform: str | None = None) -> DataFrame:
    """Financial facts published (and revised) by ``as_of``; trailing figures need a transform's hash."""
    rows = facts.where((F.col(published) <= as_of) & (F.col(revised).isNull() | (F.col(revised) <= as_of)))
    if trailing is not None:
        rows = rows.where(guard(~F.col(trailing) | F.col(transform).isNotNull(), "a trailing figure names no transform"))
    return rows


def metric_rows(df: DataFrame, metrics: Sequence[tuple[str, object, str]], start: str, end: str) -> DataFrame:
    """Rows (metric_ref, value, unit, sample_start, sample_end, sample_size, status) of aggregates."""
    values = [F.struct(F.lit(ref).alias("metric_ref"), value.cast("double").alias("value"), F.lit(unit).alias("unit")) for ref, value, unit in metrics]
    one = df.agg(F.array(*values).alias("m"), F.min(start).cast("string").alias("sample_start"), F.max(end).cast("string").alias("sample_end"), F.count(F.lit(1)).alias("sample_size"))
    rows = one.select(F.explode("m").alias("m"), "sample_start", "sample_end", "sample_size").select("m.metric_ref", "m.value", "m.unit", "sample_start", "sample_end", "sample_size")
    sound = F.col("value").isNotNull() & ~F.isnan("value") & (F.col("sample_size") > 0)
    return rows.withColumn("status", F.when(sound, "observed").otherwise("unavailable"))


def decode_metrics(rows: DataFrame, known: Sequence[str]) -> DataFrame:
    """Metric rows as (metric_ref, value, sample_size): one for each metric, finite, with a positive sample, of a known name."""
    n = F.count(F.lit(1)).over(Window.partitionBy("metric_ref"))
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf"))
    sound = finite & (F.col("sample_size") > 0) & F.col("metric_ref").isin(*known) & (F.col("__n") == 1)
    return rows.withColumn("__n", n).where(guard(F.coalesce(sound, F.lit(False)), "a metric is unknown, repeated, or has no finite value")).select("metric_ref", "value", "sample_size")


def visible_to(decisions: DataFrame, facts: DataFrame, on: Sequence[str], decision: str, available: str) -> DataFrame:
    """Each decision with the facts of its keys that were available by then, gathered, and a trace of what was read.

    Adds ``facts`` (an array of the facts' other columns), ``facts_read`` and ``last_available``. No code
    behind it can see a later fact, since none is there.
    """
    rest = [c for c in facts.columns if c not in on]
    known = facts.select(*[F.col(k).alias(f"__{k}") for k in on], F.struct(*rest).alias("__fact"), F.col(available).alias("__at"))
    tagged = decisions.withColumn("__row", F.monotonically_increasing_id())
    match = reduce(and_, [F.col(k) == F.col(f"__{k}") for k in on]) & (F.col("__at") <= F.col(decision))
    each = tagged.join(known, match, "left")
    held = [F.first(c).alias(c) for c in decisions.columns]
    return each.groupBy("__row").agg(*held, F.array_sort(F.collect_list("__fact")).alias("facts"), F.count("__at").alias("facts_read"), F.max("__at").alias("last_available")).drop("__row")
