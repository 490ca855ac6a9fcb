"""The corpus pipeline: language, exact copies, near copies, secrets, packing.

``STAGES`` lists (name, function) in order. Each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``; all but the last
return the columns of ``documents``. ``run`` applies them to the documents of a folder.

Decisions: documents without an identified language go; of equal texts the longest stays (smallest
id on ties); of each group of near-duplicates the smallest id stays; secret values are masked in
the text, so that no document is lost to them; what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import kept_alone, release, table, written
from tidemark.llm.dedup_exact import keep_first
from tidemark.llm.dedup_near import near_dedup
from tidemark.llm.langid import keep_identified
from tidemark.llm.packing import pack_documents
from tidemark.llm.secrets import mask_secrets

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _without(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose id is decided against; a null id is never dropped.

    Only the ids that go are joined. An id that any of its rows keeps stays, with all its rows.
    """
    gone = decisions.where(~F.col("kept") & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("gone")).distinct()
    gone = written(gone.join(decisions.where("kept").select("doc_id"), F.col("gone") == F.col("doc_id"), "left_anti"), "gone")
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti").select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return keep_identified(docs.select(*COLUMNS))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_first(docs.select(*COLUMNS))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return _without(docs, near_dedup(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secret values masked."""
    return mask_secrets(docs.select(*COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("exact", exact), ("near", near), ("secrets", secrets), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, kept_alone(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned language models, similarity links and tokenizers are beyond SQL.
ORACLE_SQL = None
