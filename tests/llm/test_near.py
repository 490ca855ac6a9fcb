"""MinHash near-duplicates against all pairs of full sets."""

import random

import numpy as np
import pytest

from tidemark.llm import dedup_near as near


def shingle_set(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return set()
    if len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {n: n for n in range(len(rows))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for n, (_, s) in enumerate(sets):
        for item in s:
            index.setdefault(item, []).append(n)
    for n, (_, s) in enumerate(sets):
        seen = {m for item in s for m in index[item] if m < n}
        for m in seen:
            both = len(s & sets[m][1])
            if 100 * both >= 75 * (len(s) + len(sets[m][1]) - both):
                parent[find(n)] = find(m)
    low = {}
    for n, (i, _) in enumerate(sets):
        root = find(n)
        if i is not None:
            low[root] = min(low.get(root, i), i)
    return sorted([(i, len(s), low.get(find(n)) if s else i) for n, (i, s) in enumerate(sets)], key=str)


def result(spark, rows, schema="doc_id long, text string"):
    out = near.near_dedup(spark.createDataFrame(rows, schema)).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in out], key=str)


def test_documents_of_the_test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert result(spark, rows) == brute(rows)


def family(rng, base, n, first, edits):
    out = []
    for k in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append((first + k, " ".join(words)))
    return out


def test_families_whose_members_link_only_through_others(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 8)
    monkeypatch.setattr(near, "SMALL", 4)
    rng = random.Random(5)
    rows = []
    for f in range(6):
        rows += family(rng, [f"f{f}x{i}" for i in range(60)], 70, 1000 * f, 3)
    base = [f"p{i}" for i in range(100)]
    rows += [(9000 + k, " ".join(base + [f"own{k}y{i}" for i in range(20 + k)])) for k in range(60)]
    rng.shuffle(rows)
    assert result(spark, rows) == brute(rows)


def test_edges_of_the_input(spark):
    rows = [(5, None), (1, ""), (2, "  \t\n"), (3, "one two"), (4, "ONE\ttwo"), (None, "one two"), (7, "a b c d e f"), (7, "a b c d e f"), (8, "É b c d e"), (9, "é b c d e"), (10, "a b c d e"), (11, " ".join(map(str, range(30000))))]
    assert result(spark, rows) == brute(rows)
    assert result(spark, [], "doc_id long, text string") == []


def test_extra_columns_do_no_harm(spark):
    docs = spark.createDataFrame([(1, "a b c d e", 4, 5), (2, "a b c d e", 6, None)], "doc_id long, text string, rep long, key long")
    assert [(r.doc_id, r.component_id) for r in near.near_dedup(docs).orderBy("doc_id").collect()] == [(1, 1), (2, 1)]


@pytest.mark.parametrize("away", range(near.LIMIT + 1))
def test_every_pair_within_the_limit_shares_a_key(away):
    rng = np.random.default_rng(away)
    for _ in range(50):
        one = rng.integers(0, 1 << 16, near.PLACES).astype("<u2")
        two = one.copy()
        two[rng.choice(near.PLACES, away, replace=False)] ^= 1
        a, b = near.keys_of(np.stack([one, two]))
        assert (a == b).any()


def test_signature_of_long_sets_is_the_plain_minimum():
    items = near.shingles(" ".join(f"w{i}" for i in range(9000)))
    plain = (np.min(items[:, None] * near._HASH, axis=0) >> np.uint64(8)).astype("<u2").tobytes()
    assert near.signature(items) == plain


def test_components(spark):
    from tidemark.llm.components import components

    rng = random.Random(2)
    path = list(range(60))
    rng.shuffle(path)
    links = list(zip(path, path[1:], strict=False)) + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (200, 201), (201, 200)]
    out = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert out == {**{k: 0 for k in range(60)}, **{100 + k: 100 for k in range(50)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_one_large_group_is_not_expanded(spark, monkeypatch):
    """20 000 near copies of a document: rows made stay within three for each, and nothing is lost."""
    made, plain = [], near.grouped
    monkeypatch.setattr(near, "grouped", lambda rows, *more: (made.append(rows.count()), plain(rows, *more))[1])
    rng, n = random.Random(8), 20_000
    base, rows, alone = [f"b{i}" for i in range(100)], [], set()
    for k in range(n):
        words, edits = list(base), 3 if k % 10 == 9 else rng.randrange(3)  # of three edits far apart, 81 of 111 shingles are left
        for at in rng.sample(range(4, 96, 6), edits):
            words[at] = f"w{k}x{at}"
        if edits == 3:
            alone.add(k)
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in near.near_dedup(docs).collect()}
    assert got == {k: k if k in alone else 0 for k in range(n)}
    assert made and sum(made) <= 3 * n


def test_pairs_at_the_threshold_are_found(spark):
    """2000 pairs of similarity 0.75 to 0.78 and of sets from 20 to 1500 shingles: every one is a link."""
    rng, rows, pairs = random.Random(3), [], []
    while len(pairs) < 2000:
        k, n = len(pairs), rng.choice((24, 40, 80, 200, 500, 1500))
        words = [f"p{k}i{i}" for i in range(n)]
        other = words[: n - rng.randrange(max(2, n // 3))] if rng.random() < 0.5 else list(words)
        if len(other) == n:
            for at in range(2, n, rng.choice((33, 36, 38, 40, 45))):
                other[at] = f"q{k}i{at}"
        a, b = shingle_set(" ".join(words)), shingle_set(" ".join(other))
        if 0.75 <= len(a & b) / len(a | b) <= 0.78:
            pairs.append((2 * k, 2 * k + 1))
            rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    got = {r.doc_id: r.component_id for r in near.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    assert sum(got[b] == a for a, b in pairs) / len(pairs) == 1.0
