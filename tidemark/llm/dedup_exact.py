"""Exact deduplication by progressive refinement, in DataFrame operations only.

Texts are compared after deleting the six ASCII white-space characters. A text can only equal
another of the same normalised length, then of the same prefix hash, then of the same SHA-256, so
each round looks only at what the round before left over:

1. length and prefix hash are counted by one map-side combined aggregation; a length or a prefix
   that occurs once ends there;
2. rows of the surviving prefixes are read again, found by a bitmap of their ids of fixed size, and
   grouped by their full hash (a caller that needs the digest of every row has it taken at once);
3. the winner of each group (most code points, then smallest ``doc_id``) goes back to its rows.

Nothing but keys is shuffled, never a text. Hot groups meet only partial aggregates; the joins
that lead back to rows exchange both sides, so adaptive execution splits a hot key.

Defined cases: null text counts as empty, and empty texts are equal to each other. A null
``doc_id`` loses every tie. Rows that repeat both ``doc_id`` and code points are equal in all that
decides: they share a decision in :func:`exact_dedup`, and :func:`keep_first` leaves one of them.
Columns other than the key and the text are never read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, table, written

#: Normalised characters under the prefix hash.
PREFIX = 256


def normalised(text: Column) -> Column:
    """Text without the characters 0x20 and 0x09 to 0x0D."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t-\\r]+", "")


#: Bits of the filter of surviving ids.
BITS = 1 << 23


def _among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The ``rows`` whose doc_id may be among ``ids`` (doc_id): a filter of one row of BITS bits, whatever the input."""
    place = "pmod(xxhash64(doc_id), {})".format(BITS)
    set_ = ids.select(F.expr(f"{place} div 64").alias("word"), F.expr(f"shiftleft(1L, cast({place} % 64 as int))").alias("bits"))
    every = rows.sparkSession.range(BITS // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = set_.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    held = words.agg(F.expr("transform(array_sort(collect_list(struct(word, bits))), x -> x.bits)").alias("held"))
    bit = F.expr(f"(shiftright(held[cast({place} div 64 as int)], cast({place} % 64 as int)) & 1) = 1")
    return rows.join(F.broadcast(held), bit, "left_semi")


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", digest_all: bool = False) -> DataFrame:
    """Per row: ``key``, keep_id, group_size, kept and text_sha256.

    With ``digest_all`` every row carries its SHA-256, computed while the row is scanned for its
    prefix. Without it, a second scan reads the content of surviving rows only, and the digest of
    a row that no other row can equal is null.
    """
    base = documents(docs, key, text).toDF("doc_id", "text")

    def keys(rows: DataFrame, digest: bool) -> DataFrame:
        norm = rows.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n_code"), normalised(F.col("text")).alias("norm"))
        full = F.unhex(F.sha2("norm", 256)) if digest else F.lit(None).cast("binary")
        return norm.select("doc_id", "n_code", F.length("norm").alias("n_norm"), F.xxhash64(F.substring("norm", 1, PREFIX)).alias("prefix"), full.alias("full"))

    keyed = written(keys(base, digest_all), "exact-keys")
    counts = keyed.groupBy("n_norm", "prefix").agg(F.count(F.lit(1)).alias("n"))
    alive = counts.where("n > 1").select(F.xxhash64("n_norm", "prefix").alias("round2"))
    named = lambda rows: rows.withColumn("round2", F.xxhash64("n_norm", "prefix"))
    left = named(keyed).join(alive, "round2", "left_semi")
    if not digest_all:
        again = keys(_among(base, written(left.select("doc_id"), "exact-ids", slim=True)), True)
        left = written(named(again).join(alive, "round2", "left_semi"), "exact-full")

    best = F.min(F.struct((-F.col("n_code")).alias("most"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id")))
    groups = (
        left.groupBy("n_norm", "prefix", "full")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select(F.col("full").alias("g_full"), F.col("best.id").alias("g_id"), (-F.col("best.most")).alias("g_code"), "group_size")
    )
    if digest_all:
        joined = keyed.join(groups, F.col("full") == F.col("g_full"), "left")
    else:
        single = named(keyed).join(alive, "round2", "left_anti").select("doc_id", "n_code", "full")
        joined = left.select("doc_id", "n_code", "full").join(groups, F.col("full") == F.col("g_full"), "left").unionByName(single, allowMissingColumns=True)
    alone = F.col("group_size").isNull()
    return joined.select(
        F.col("doc_id").alias(key),
        F.when(alone, F.col("doc_id")).otherwise(F.col("g_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(alone, F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("n_code") == F.col("g_code"))).alias("kept"),
        F.lower(F.hex("full")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of equal texts, all columns as they are.

    Rows are told apart by their id. Where an id is null or has several rows, which is rare, they are
    told apart by their text's digest too.
    """
    decided = written(exact_dedup(docs, key, text), "decided")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("id"))  # no column of ours can clash
    odd = written(decided.groupBy(F.col(f"`{key}`").alias("odd")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 or odd is null").select("odd"), "odd", slim=True)
    gone = written(decided.where(~F.col("kept") & F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("gone")).distinct(), "gone", slim=True)
    plain = rows.join(gone, F.col("id") == F.col("gone"), "left_anti")
    if odd.isEmpty():
        return plain.select("row.*")
    plain = plain.join(odd, F.col("id").eqNullSafe(F.col("odd")), "left_anti")
    told = F.col(f"row.`{text}`")
    mine = rows.join(odd, F.col("id").eqNullSafe(F.col("odd")), "left_semi").select("row", "id", F.length(F.coalesce(told, F.lit(""))).alias("n"), F.sha2(normalised(told), 256).alias("sha"))
    winners = decided.where("group_size > 1").groupBy("text_sha256").agg(F.first("keep_id").alias("keep"))
    best = mine.join(winners, F.col("sha") == F.col("text_sha256"), "left").where(F.col("text_sha256").isNull() | F.col("id").eqNullSafe(F.col("keep")))
    # of rows with one id and text, one; the bare key is grouped, never a text
    one = best.groupBy("id", "sha").agg(F.max_by("row", "n").alias("row"))
    return plain.select("row").unionByName(one.select("row")).select("row.*")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)


#: The same rows in DuckDB.
ORACLE = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_code,
         regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]', '', 'g') AS norm
  FROM documents
), h AS (SELECT doc_id, n_code, sha256(norm) AS text_sha256 FROM n),
r AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_code DESC, doc_id ASC) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM h
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
