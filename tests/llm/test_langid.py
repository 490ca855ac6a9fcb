"""Language identification: held-out accuracy, the filters against plain sets, and edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = langid.op9_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(out) == 1000
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in out if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    right = sum(r.lang_pred == r.lang for r in held) / len(held)
    assert right >= 0.97, right
    assert all(0 <= r.score <= 1 for r in out)


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(langid.fold(F.col("doc_id")) == 2, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    assert sorted(langid.identify(docs).collect()) == sorted(langid.identify(wrong).collect())


def test_masks_hold_every_member_and_few_others(spark):
    rng = np.random.default_rng(0)
    members = [rng.integers(0, 1 << 63, 5000, dtype=np.uint64) for _ in range(70)]
    rows = [(k, int(g), 1) for k, grams in enumerate(members) for g in grams.astype(np.int64)]
    model = langid.Model.of([f"l{k:02}" for k in range(70)], langid.filters_of(spark.createDataFrame(rows, "lang int, gram long, n long"), 70))
    other = rng.integers(0, 1 << 63, 20000, dtype=np.uint64)
    for k, grams in enumerate(members):
        bit = np.uint64(1) << np.uint64(k % 64)
        assert (model.masks(grams)[:, k // 64] & bit).all()
        assert abs((model.masks(other)[:, k // 64] & bit > 0).mean() - model.false[k]) < 0.002


def plain(text):
    padded, out = "", []
    for c in text.lower():
        padded += c if c.isalpha() else " "
    padded = f" {' '.join(padded.split(' '))} "
    while "  " in padded:
        padded = padded.replace("  ", " ")
    for i in range(len(padded) - 2):
        if padded[i + 1] != " ":
            out.append(padded[i : i + 3])
    return out


@pytest.mark.parametrize("text", ["Ab, cd!", "x", "  ßé--É 12 a", "a" * 40, "..a..b c"])
def test_trigrams_are_those_of_letter_runs(text, monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 7)
    got = np.concatenate(list(langid.trigrams(text)))
    names = plain(text)
    assert len(got) == len(names)
    assert len(set(got.tolist())) == len(set(names))


def test_edges_of_the_input(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "", None), (5, "123 !?", "de"), (None, "the dog", "en"), (7, "the cat", None), (7, "the cat", None), (8, "ЖЖЖ", None)]
    schema = "doc_id long, text string, lang string"
    out = {(r.doc_id, r.lang_pred) for r in langid.identify(spark.createDataFrame(rows, schema).withColumn("score", F.lit(1))).collect()}
    assert {i for i, lang in out if lang == "und"} == {3, 4, 5}
    assert langid.identify(spark.createDataFrame([], schema)).collect() == []
    bare = [(i, t, None) for i, t, _ in rows]
    assert {r.lang_pred for r in langid.identify(spark.createDataFrame(bare, schema)).collect()} == {"und"}
    assert langid.keep_identified(spark.createDataFrame(rows, schema)).columns == ["doc_id", "text", "lang"]


def test_every_language_is_learned(spark):
    words = [chr(0x4E00 + 3 * k) + chr(0x4E01 + 3 * k) + chr(0x4E02 + 3 * k) for k in range(300)]
    docs = spark.createDataFrame([(8 * k + n, f"{w} {w}", f"l{k:03}") for k, w in enumerate(words) for n in range(8)], "doc_id long, text string, lang string")
    model = langid.learn(docs)
    assert sorted(model.languages) == [f"l{k:03}" for k in range(300)]
    assert [model.predict(w)[0] for w in words] == [f"l{k:03}" for k in range(300)]
    assert langid.keep_identified(docs).count() == 2400


def test_many_languages_share_the_sample(spark, monkeypatch):
    monkeypatch.setattr(langid, "ROWS", 1)
    docs = spark.createDataFrame([(k, "the cat and the dog" if k % 2 else "der Hund und die Katze", "en" if k % 2 else "de") for k in range(4000)] + [(5000, "le chat", "fr"), (5001, "le chat", "fr")], "doc_id long, text string, lang string")
    assert sorted(langid.learn(docs).languages) == ["de", "en", "fr"]
    assert langid.learn(docs).predict("le chat")[0] == "fr" and langid.learn(docs).predict("the dog")[0] == "en"


def test_extra_columns_ties_and_long_texts(spark):
    rows = [(k, t, lang, 1, 2) for k, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)]
    rows += [(100, "the cat " * 200_000, None, 1, 2), (101, "qqq", None, 1, 2), (102, "1 2 3", None, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, found int, row int")
    out = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert out[100].lang_pred == "en" and out[101].score == 0 and out[102].lang_pred == "und"
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(range(40)) | {100}
