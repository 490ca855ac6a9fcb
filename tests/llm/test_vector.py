"""Vector near-duplicates against all pairs."""

import numpy as np
import pytest

from tidemark.llm import dedup_vector as vector


def brute(rows, threshold=vector.THRESHOLD):
    good = [n for n, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    degree, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(good):
        for b in good[:k]:
            if rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                    degree[a] += 1
                    degree[b] += 1
                    parent[find(a)] = find(b)
    low = {}
    for n, (i, *_) in enumerate(rows):
        low[find(n)] = min(low.get(find(n), i), i)
    return sorted((i, degree[n], low[find(n)]) for n, (i, *_) in enumerate(rows))


def result(spark, rows, schema="vec_id long, embedding array<float>, label int"):
    out = vector.vector_dedup(spark.createDataFrame(rows, schema)).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return sorted((r.vec_id, r.n_links, r.component_id) for r in out)


def test_the_test_table(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("block", [4, 64])
def test_dense_groups_and_chains(spark, monkeypatch, block):
    monkeypatch.setattr(vector, "BLOCK", block)
    rng = np.random.default_rng(block)
    rows = []
    for c in range(8):
        centre = rng.normal(size=12)
        for _ in range(25):
            rows.append([float(np.float32(x)) for x in centre + rng.normal(size=12) * 0.25 * (c % 3)])
    step = [[float(np.float32(np.cos(a))), float(np.float32(np.sin(a)))] + [0.0] * 10 for a in np.arange(0, 3, 0.3)]
    rows += step + [rows[0]] * 5
    rows = [(k * 7 % 1009, v, int(k % 2)) for k, v in enumerate(rows)]
    assert result(spark, rows) == brute(rows)


def test_edges_of_the_input(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, 2.0], None), (8, [1.0, 2.0], 1), (9, [2.0, 4.0], 1), (10, [1.0, 2.0], 2), (11, [1.0, 2.0, 0.0], 1), (12, [1.0, 2.0], 1), (12, [1.0, 2.0], 1), (13, [-0.0, 1.0], 3), (14, [0.0, 1.0], 3)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []
    docs = spark.createDataFrame([(None, [1.0], 1), (5, [1.0], 1), (None, [2.0, 1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in vector.vector_dedup(docs).collect()) == [("5", 1, "5"), ("None", 0, "None"), ("None", 1, "5")]


def test_boxes_skip_distant_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector, "BLOCK", 8)
    rng = np.random.default_rng(1)
    rows = []
    for c in range(16):
        centre = np.eye(16)[c]
        rows += [(c * 100 + k, [float(x) for x in centre + rng.normal(size=16) * 0.02], 1) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    eps = np.sqrt(2 - 2 * vector.THRESHOLD)
    _, classes = vector._classes(df, "vec_id", "embedding", "label")
    blocks = vector._blocks(classes, vector._bases(classes), eps)
    n = blocks.count()
    assert vector._pairs(blocks, eps).count() < 0.5 * n * (n + 1) / 2
    assert result(spark, rows) == brute(rows)


def test_extra_columns_and_both_precisions(spark):
    rows = [(k, [1.0, 0.1 * (k % 7), 0.2], "l", 1, 2, 3) for k in range(30)]
    for kind in ("array<float>", "array<double>"):
        docs = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label string, code int, part int, rep int")
        got = sorted((r.vec_id, r.n_links, r.component_id) for r in vector.vector_dedup(docs).collect())
        assert got == brute([(k, v, lab) for k, v, lab, *_ in rows])
