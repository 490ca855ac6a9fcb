"""The pipeline against a plain run of its decisions on the small tables."""

from collections import defaultdict

import numpy as np

import corpus_pipeline
from tidemark.llm import secrets
from tests.llm.test_exact import brute as brute_exact
from tests.llm.test_near import brute as brute_near

SF = "/root/testdata/sf0.01"


def test_stages_against_plain_decisions(spark, tmp_path):
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        rows = [(i, r.text) for i, r in before.items()]
        if name != "packing":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
            kept = {r.doc_id: r for r in docs.collect()}
        if name == "language":
            assert len(kept) >= 0.99 * len(before) and all(kept[i] == before[i] for i in kept)
        if name == "exact":
            assert set(kept) == {i for i, keep, *_ in brute_exact(rows) if i == keep} and len(kept) < len(before)
        if name == "near":
            assert set(kept) == {i for i, _, low in brute_near(rows) if i == low} and len(kept) < len(before)
        if name == "secrets":
            assert set(kept) == set(before)
            for i, r in kept.items():
                assert r.text == secrets.masked(before[i].text) and (r.n_chars == len(r.text) or r.text == before[i].text)
            assert any(secrets.MASK in r.text for r in kept.values())
        if name == "packing":
            pieces = defaultdict(list)
            for r in docs.collect():
                pieces[r.doc_id].append((r.start, r.length))
            assert set(pieces) == set(before)
            for spans in pieces.values():
                spans.sort()
                assert [s for s, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1].tolist()]


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 500 and "sequence_id" in out.columns


def test_odd_rows_pass_every_stage(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, "the cat and the dog", "en", None, None), (None, "the cat", "en", "s", 7), (2, None, None, None, None), (3, "", "de", "s", 0), (1, "the cat and the dog", "en", None, None), (4, "der Hund und die Katze im Haus", "de", "s", 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}{len(data)}")
            docs = spark.read.parquet(f"{tmp_path}/{name}{len(data)}")
        assert {r.doc_id for r in docs.collect()} == ({1, None, 4} if data else set())
