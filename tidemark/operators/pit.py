"""Point-in-time selection: what was visible, which revision was valid, and joins as of a time.

Guards are filters, because an unused column would be pruned: they raise while the plan runs, for
the offending rows only. Business filters belong after a selection; only filters on entity columns
may stand before it, and Catalyst itself pushes those below the window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import ContractError


def visible(available: Sequence[str], clock: Column, inclusive: bool = True) -> Column:
    """All availability times are at or (exclusively) before the clock."""
    if not available:
        raise ContractError("no availability field")
    return reduce(and_, [F.col(a) <= clock if inclusive else F.col(a) < clock for a in available])


def guard(passes: Column, message: str) -> Column:
    """A filter predicate that raises where ``passes`` does not hold."""
    return F.when(passes, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))


def revision_winner(facts: DataFrame, entity: Sequence[str], order: Sequence[str], on_tie: str = "error") -> DataFrame:
    """The newest version of each entity by ``order``, nulls oldest; a tied winner is an error.

    ``on_tie`` may be ``first`` to take one of tied versions that are equal anyway.
    """
    newest = Window.partitionBy(*entity).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    ranked = facts.withColumn("__n", F.row_number().over(newest))
    if on_tie == "first":
        return ranked.where("__n = 1").drop("__n")
    ranked = ranked.withColumn("__tied", F.count(F.lit(1)).over(Window.partitionBy(*entity, *order)))
    keep = F.when(F.col("__n") == 1, guard(F.col("__tied") == 1, "an entity has two newest versions")).otherwise(F.lit(False))
    return ranked.where(keep).drop("__n", "__tied")


def effective(start: str, end: str, clock: Column, closed: tuple[bool, bool] = (True, False)) -> Column:
    """The clock lies in [start, end), an open end being null; ``closed`` sets either end."""
    after = F.col(start) <= clock if closed[0] else F.col(start) < clock
    before = F.col(end) >= clock if closed[1] else F.col(end) > clock
    return after & (F.col(end).isNull() | before)


def effective_rows(facts: DataFrame, entity: Sequence[str], start: str, end: str, clock: Column, closed: tuple[bool, bool] = (True, False)) -> DataFrame:
    """The row of each entity that is in force at the clock; two are an error."""
    rows = facts.where(effective(start, end, clock, closed)).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*entity)))
    return rows.where(guard(F.col("__n") == 1, "two rows of an entity are in force")).drop("__n")


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, columns: Sequence[str], how: str = "left", inclusive: bool = True, suffix: str = "") -> DataFrame:
    """For each left row the latest right row of its keys at (or before) its time.

    Both sides go through one exchange on the keys: they are stacked, and a window carries the last
    right row forward. Ties of the right side take the greatest columns. Rows of a key are streamed
    through the window in order of time, so neither side has to fit in memory and no range join
    multiplies rows. Null times or keys on the left find nothing; on the right they are left out.
    """
    kinds = {f.name: f.dataType for f in right.schema.fields}
    found = F.struct(*[F.col(c).alias(c) for c in columns])
    facts = right.where(F.col(right_time).isNotNull() & reduce(and_, [F.col(k).isNotNull() for k in on]))
    facts = facts.groupBy(*on, F.col(right_time).alias("__t")).agg(F.max(found).alias("__found"))
    row = F.struct(*[F.col(c) for c in left.columns])
    asking = left.select(*[F.col(k).alias(f"__k{n}") for n, k in enumerate(on)], F.col(left_time).alias("__t"), F.lit(1 if inclusive else -1).alias("__turn"), row.alias("__row"), F.lit(None).cast(facts.schema["__found"].dataType).alias("__found"))
    facts = facts.select(*[F.col(k).alias(f"__k{n}") for n, k in enumerate(on)], "__t", F.lit(0).alias("__turn"), F.lit(None).cast(asking.schema["__row"].dataType).alias("__row"), "__found")
    keys = [f"__k{n}" for n in range(len(on))]
    ordered = Window.partitionBy(*keys).orderBy(F.col("__t").asc_nulls_first(), "__turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = asking.unionByName(facts).withColumn("__last", F.last("__found", ignorenulls=True).over(ordered)).where("__row is not null")
    known = reduce(and_, [F.col(k).isNotNull() for k in keys]) & F.col("__t").isNotNull()
    out = carried.select("__row.*", *[F.when(known, F.col(f"__last.{c}")).cast(kinds[c]).alias(f"{c}{suffix}") for c in columns], (known & F.col("__last").isNotNull()).alias("__hit"))
    return (out.where("__hit") if how == "inner" else out).drop("__hit")


def asof_versions(consumers: DataFrame, facts: DataFrame, on: Sequence[str], consumer: Sequence[str], clock: str, available: Sequence[str], order: Sequence[str], greatest: Sequence[str] = ()) -> DataFrame:
    """For each consumer the newest version, by ``order``, of all that were available at its clock.

    ``consumer`` is the consumers' key. Versions are not ordered by availability, so this is an
    equi join on ``on`` with an aggregate that keeps one version for each consumer. Columns named as
    ``greatest`` are the greatest of all available versions, not the newest one's.
    """
    facts = facts.select(*[F.col(c).alias(f"f_{c}") for c in facts.columns])
    seen = reduce(and_, [F.col(f"f_{a}") <= F.col(clock) for a in available])
    both = consumers.join(facts, reduce(and_, [F.col(c) == F.col(f"f_{c}") for c in on]) & seen)
    best = F.max_by(F.struct(*[c for c in both.columns if c.startswith("f_")]), F.struct(*[F.col(f"f_{c}") for c in order]))
    return both.groupBy(*consumer, clock).agg(best.alias("__best"), F.count(F.lit(1)).alias("versions"), *[F.max(f"f_{c}").alias(f"__top_{c}") for c in greatest]).select(*consumer, clock, "versions", *[F.col(f"__top_{c[2:]}" if c[2:] in greatest else f"__best.{c}").alias(c[2:]) for c in facts.columns if c[2:] not in (*consumer, clock)])


def latest_revision(facts: DataFrame, economic: Sequence[str], available: str, revision: str, as_of: Column) -> DataFrame:
    """Both times at or before ``as_of``; of each economic key the greatest (revision, available)."""
    seen = facts.where((F.col(available) <= as_of) & (F.col(revision) <= as_of))
    return revision_winner(seen, economic, [revision, available])


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], at: str, start: str, end: str, closed_end: bool = False) -> DataFrame:
    """Each left row with the right rows of its keys in force at its time; an empty interval is an error."""
    spans = right.where(guard(F.col(end).isNull() | (F.col(start) < F.col(end)) | (F.lit(closed_end) & (F.col(start) == F.col(end))), "an interval is empty"))
    spans = spans.select(*[F.col(c).alias(f"__r_{c}" if c in on else c) for c in spans.columns])
    inside = (F.col(start) <= F.col(at)) & (F.col(end).isNull() | (F.col(end) >= F.col(at) if closed_end else F.col(end) > F.col(at)))
    return left.join(spans, reduce(and_, [F.col(k) == F.col(f"__r_{k}") for k in on]) & inside, "left").drop(*[f"__r_{k}" for k in on])


def require_one(df: DataFrame, key: Sequence[str], matched: str) -> DataFrame:
    """Raise unless every key has exactly one row and that row is matched."""
    n = Window.partitionBy(*key)
    rows = df.withColumn("__n", F.count(F.lit(1)).over(n))
    return rows.where(guard((F.col("__n") == 1) & F.col(matched).isNotNull(), "a row has no match or several")).drop("__n")


def resolve_alias(rows: DataFrame, aliases: DataFrame, alias: str, at: str) -> DataFrame:
    """Each row with the instrument that its alias names at its time; none or several are an error.

    ``aliases``: alias, instrument, start, end; both ends belong to the interval, a null end is open.
    """
    known = aliases.select(F.col("alias").alias("__alias"), F.col("instrument"), F.col("start").alias("__from"), F.col("end").alias("__to"))
    tagged = rows.withColumn("__row", F.monotonically_increasing_id())
    inside = (F.col("__from") <= F.col(at)) & (F.col("__to").isNull() | (F.col(at) <= F.col("__to")))
    found = tagged.join(known, (F.col(alias) == F.col("__alias")) & inside, "left")
    one = found.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("__row")))
    return one.where(guard((F.col("__n") == 1) & F.col("instrument").isNotNull(), "an alias names no instrument, or several")).drop("__alias", "__from", "__to", "__row", "__n")


def completed_sessions(facts: DataFrame, sessions: DataFrame, instrument: str, day: str) -> DataFrame:
    """Facts of completed sessions only: a semi join on (instrument, date) pairs."""
    done = sessions.select(F.col(sessions.columns[0]).alias("__i"), F.col(sessions.columns[1]).alias("__d"))
    return facts.join(done, (facts[instrument] == done["__i"]) & (facts[day] == done["__d"]), "left_semi")


def missing(children: DataFrame, parents: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Children without a parent; a null key has none."""
    found = parents.select(*[F.col(p).alias(f"__p{n}") for n, (_, p) in enumerate(keys)])
    return children.join(found, reduce(and_, [children[c] == found[f"__p{n}"] for n, (c, _) in enumerate(keys)]), "left_anti")


def one_to_one(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """A full join of two tables whose keys have to be unique and the same on both sides."""
    a = left.withColumn("__n_left", F.count(F.lit(1)).over(Window.partitionBy(*on)))
    b = right.withColumn("__n_right", F.count(F.lit(1)).over(Window.partitionBy(*on)))
    both = a.join(b, list(on), "full_outer")
    closed = F.col("__n_left").eqNullSafe(F.lit(1)) & F.col("__n_right").eqNullSafe(F.lit(1))
    return both.where(guard(closed, "keys differ between the sides or repeat")).drop("__n_left", "__n_right")


def table_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows, with their multiplicity, that only one of two tables has."""
    b = b.select(*a.columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionAll(b.exceptAll(a).withColumn("side", F.lit("right")))
