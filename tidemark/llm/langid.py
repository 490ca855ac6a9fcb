"""Language identification with language-bitmask n-gram filters.

A text's n-grams are the character trigrams of its lower-cased letter runs, a space standing for
everything between runs. Learning counts trigrams per language over labelled rows; a trigram
belongs to every language in which its relative frequency is at least ``SHARE`` of its greatest
one. The languages' Bloom filters are bit-sliced: slot s of the table is a mask whose bit l is
language l's Bloom bit s, so that the AND of a trigram's slots is the set of all languages that
contain it, whatever their number (one 64-bit word for every 64 languages).

A text is decided by popcounts: c_l counts its trigrams whose mask has bit l. A filter with a
share d_l of its slots set answers falsely with probability f_l = d_l ** PROBES, so the count is
corrected to (c_l - n f_l) / (1 - f_l). The language with the largest corrected count wins (ties:
the one with more labelled rows, then by name); the score is its share of all corrected counts.

Learning reads a bounded sample: about ``ROWS_PER_LANGUAGE`` labelled rows of each language, taken
by a hash of the key, whole texts of them. Every label is learned; with so many of them that the
sample would pass ``ROWS`` rows, each language gives an equal part of these, ``LEAST_ROWS`` at
least, and all its rows if it has no more. Counting rows per language covers the whole table. The
filters' bits are set in Spark, and what reaches the driver is their table, of fixed size for every 64
languages.

Defined cases: a null text and a text without any letter are ``und`` with score 0. A text none of
whose trigrams is known takes the language with most labelled rows, with score 0; with no learned
language at all everything is ``und``. Rows without a label, and rows whose crc32 of the key is
null, teach nothing. Repeated rows are treated one by one. Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, gathered, map_batches, short_batches, table, texts_of

ROWS_PER_LANGUAGE = 4000
ROWS, LEAST_ROWS = 1_024_000, 32
SHARE = 0.5
SLOT_BITS, PROBES = 20, 2
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: Trigrams hashed at once.
PIECE = 1 << 18

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def trigrams(text: str):
    """Hashes of the trigrams of a text, in pieces; nothing if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _is_letter()[codes]
    if not letter.any():
        return
    codes = np.where(letter, codes, 32)
    keep = np.ones(len(codes), bool)
    keep[1:] = letter[1:] | letter[:-1]  # one space for each gap
    codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint64)
    for at in range(0, len(codes) - 2, PIECE):
        part = codes[at : at + PIECE + 2]
        middle = part[1:-1] != 32
        mix = (part[:-2] * np.uint64(0x9E3779B97F4A7C15) + part[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + part[2:] * np.uint64(0x165667B19E3779F9))[middle]
        mix ^= mix >> np.uint64(29)
        mix *= np.uint64(0xBF58476D1CE4E5B9)
        yield mix ^ (mix >> np.uint64(32))


def _slots(grams: np.ndarray):
    for probe in range(PROBES):
        yield ((grams >> np.uint64(probe * SLOT_BITS)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


@dataclass
class Model:
    """Languages, most labelled rows first; the bit-sliced filters; each language's false rate."""

    languages: list[str]
    filters: np.ndarray
    false: np.ndarray

    @classmethod
    def of(cls, languages: list[str], filters: np.ndarray) -> Model:
        filled = np.array([((filters[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))])
        return cls(languages, filters, filled**PROBES)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """(trigrams, words): all languages that contain each trigram."""
        out = None
        for slots in _slots(grams):
            out = self.filters[slots] if out is None else out & self.filters[slots]
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        counts, n = np.zeros(len(self.languages)), 0
        for grams in trigrams(text or ""):
            masks = self.masks(grams)
            n += len(grams)
            for k in range(len(counts)):
                counts[k] += np.count_nonzero(masks[:, k // 64] & (np.uint64(1) << np.uint64(k % 64)))
        if not n or not len(counts):
            return UNKNOWN, 0.0
        true = np.maximum(0.0, (counts - n * self.false) / (1 - self.false))
        best = int(np.argmax(true))
        return self.languages[best], float(true[best] / true.sum()) if true.sum() else 0.0


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string")) % FOLDS


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> Model:
    """A model of the labelled rows outside the held-out fold."""
    rows = documents(docs, key, text, label).toDF("id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("id")) != HELD_OUT))
    seen = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").collect()
    languages = [r.lang for r in seen]
    if not seen:
        return Model.of(languages, np.zeros((1 << SLOT_BITS, 1), np.uint64))
    scale = 1 << 30
    each = max(LEAST_ROWS, min(ROWS_PER_LANGUAGE, ROWS // len(seen)))
    most = docs.sparkSession.createDataFrame([(r.lang, min(scale, int(scale * each / r.n))) for r in seen], "of string, most long")  # one row a language
    sample = rows.join(F.broadcast(most), F.col("lang") == F.col("of")).where(F.pmod(F.xxhash64("id", F.lit("language")), F.lit(scale)) < F.col("most"))
    place = {lang: k for k, lang in enumerate(languages)}

    def count(batch: pa.RecordBatch) -> dict | None:
        held: dict[int, list] = {}
        for lang, value in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
            held.setdefault(place[lang], []).extend(trigrams(value))
        out = {"lang": [], "gram": [], "n": []}
        for lang, grams in held.items():
            if grams:
                gram, n = np.unique(np.concatenate(grams), return_counts=True)
                out["lang"].append(np.full(len(gram), lang, np.int32))
                out["gram"].append(gram.view(np.int64))
                out["n"].append(n)
        return {c: pa.array(np.concatenate(x)) for c, x in out.items()} if out["lang"] else None

    grams = map_batches(sample.select("lang", "text"), count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return Model.of(languages, filters_of(grams, len(languages)))


def filters_of(grams: DataFrame, languages: int) -> np.ndarray:
    """The bit-sliced filters of trigram counts (lang, gram, n): set in Spark, a table of fixed size on the driver."""
    total = grams.groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("total"))
    rate = grams.join(F.broadcast(total), F.col("lang") == F.col("of")).withColumn("rate", F.col("n") / F.col("total"))  # one row a language
    most = rate.groupBy(F.col("gram").alias("g")).agg(F.max("rate").alias("most"))
    held = rate.join(most, F.col("gram") == F.col("g")).where(F.col("rate") >= SHARE * F.col("most"))
    slots = F.explode(F.array(*[F.shiftrightunsigned("gram", probe * SLOT_BITS).bitwiseAND((1 << SLOT_BITS) - 1) for probe in range(PROBES)]))
    bits = held.select(slots.alias("slot"), F.expr("lang div 64").alias("word"), F.expr("shiftleft(1L, cast(lang % 64 as int))").alias("bit"))
    words = max(1, -(-languages // 64))
    place = F.col("slot") * words + F.col("word")
    return gathered(bits.groupBy(place.alias("place")).agg(F.bit_or("bit").alias("bits")), words << SLOT_BITS).view(np.uint64).reshape(-1, words)


def language(model: Model, spark: SparkSession, text: Column) -> Column:
    """struct(lang, score) of a text column."""
    short_batches(spark)
    held = spark.sparkContext.broadcast(model)  # a table of fixed size

    @F.pandas_udf("lang string, score double")
    def decide(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([held.value.predict(t) for t in texts], columns=["lang", "score"])

    return decide(text)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """Per row: ``key``, held_out, lang_pred and score, learned from the rows' own labels."""
    model = learn(docs, key, text, label)
    rows = documents(docs, key, text).toDF("id", "text")
    out = rows.select("id", language(model, docs.sparkSession, F.col("text")).alias("found"))
    return out.select(F.col("id").alias(key), F.coalesce(fold(F.col("id")) == HELD_OUT, F.lit(False)).alias("held_out"), F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def keep_identified(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is identified: rejected are ``und`` and texts without a known trigram."""
    model = learn(docs)
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), language(model, docs.sparkSession, F.col(f"`{text}`")).alias("found"))
    return found.where((F.col("found.lang") != UNKNOWN) & (F.col("found.score") > 0)).select("row.*")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
