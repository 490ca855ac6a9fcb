"""Exact deduplication against plain grouping."""

import hashlib

import pytest

from tidemark.llm import dedup_exact as exact


def norm(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def brute(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(norm(text), []).append((-len(text or ""), key if key is not None else float("inf"), key))
    out = []
    for key, text in rows:
        members = groups[norm(text)]
        length, _, keep = min(members)
        out.append((key, keep, len(members), key == keep and -len(text or "") == length, hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, "a\tb "), (5, None), (6, ""), (7, " \n\r\x0b\x0c"), (8, "é"), (9, "é "), (10, "A b"), (11, "x" * 300 + "1"), (12, "x" * 300 + "2"), (13, "x" * 300 + " 2"), (14, "a\xa0b"), (14, "a\xa0b"), (None, "solo"), (15, "single"), (None, "pair"), (16, "pair")]


@pytest.mark.parametrize("everywhere", [True, False])
def test_rows_against_plain_groups(spark, everywhere):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 as norm", "2 as full", "3 as n")
    out = exact.exact_dedup(docs, digest_all=everywhere).collect()
    got = sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in out], key=str)
    if everywhere:
        assert got == brute(ROWS)
    else:  # the digest is known where another row could be equal
        assert [g[:4] for g in got] == [b[:4] for b in brute(ROWS)]
        assert all(g[4] == b[4] for g, b in zip(got, brute(ROWS), strict=True) if g[2] > 1)
        assert any(g[4] is None for g in got)


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact.exact_dedup(docs, digest_all=True).collect() == [] and exact.exact_dedup(docs).collect() == []


def test_the_least_long_is_an_id(spark):
    docs = spark.createDataFrame([(-(1 << 63), "a"), (2, "a"), ((1 << 63) - 1, "b")], "doc_id long, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact.exact_dedup(docs, digest_all=True).collect()} == {(-(1 << 63), -(1 << 63), True), (2, -(1 << 63), False), ((1 << 63) - 1, (1 << 63) - 1, True)}


def test_very_long_texts(spark):
    long = "word " * 400_000
    rows = [(1, long + "x"), (2, long + "y"), (3, long.replace(" ", "\n") + "x"), (4, long + " x")]
    out = exact.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in out) == [(1, 4, False), (2, 2, True), (3, 4, False), (4, 4, True)]


def test_one_row_of_each_group_stays(spark):
    rows = [*ROWS, (1, "a b"), (20, "u v"), (20, "w"), (20, "uv "), (21, "w"), (22, " w "), (None, "solo"), (None, "a\tb   "), (30, "z"), (30, "z")]
    docs = spark.createDataFrame([(k, t, n) for n, (k, t) in enumerate(rows)], "doc_id long, text string, odd int")
    out = exact.keep_first(docs).collect()
    groups = {}
    for key, text in rows:
        groups.setdefault(norm(text), []).append((-len(text or ""), key is None, key or 0))
    want = sorted((str(None if none else key), n, -size) for n, (size, none, key) in ((n, min(g)) for n, g in groups.items()))
    assert sorted((str(r.doc_id), norm(r.text), len(r.text or "")) for r in out) == want
    assert out[0].asDict().keys() == {"doc_id", "text", "odd"}
