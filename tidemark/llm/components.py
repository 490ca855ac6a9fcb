"""Connected components of a graph given as links, by contraction.

Every round each label hooks onto its smallest neighbour, two pointer jumps shorten the chains,
and the links are rewritten to the new labels; links inside one label vanish. The number of labels
with a link at least halves each round, so rounds are logarithmic in the links. Nothing is
gathered on the driver but the count of remaining links, and each round's tables are written to
the shared folder, so that a lost executor repeats one round at most.

A label with very many links meets only partial aggregates and joins whose sides are both
exchanged, which adaptive execution splits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import release, written


def _both(links: DataFrame) -> DataFrame:
    return links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node with a link; the component is its smallest node.

    ``links`` has two long columns ``u`` and ``v``. Direction and repeats do not matter; links with
    a null end or from a node to itself link nothing.
    """
    edges = written(links.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links", slim=True)
    labels = None
    while not edges.isEmpty():
        parent = _both(edges).groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("label"), F.least("u", "low").alias("parent"))
        for _ in range(2):
            up = parent.select(F.col("label").alias("mid"), F.col("parent").alias("top"))
            parent = parent.join(up, parent["parent"] == up["mid"]).select("label", F.col("top").alias("parent"))
        parent = written(parent, "parent", slim=True)
        if labels is None:
            labels = written(parent.select(F.col("label").alias("node"), F.col("parent").alias("component")), "labels", slim=True)
        else:
            old = labels
            labels = written(old.join(parent, old["component"] == parent["label"], "left").select("node", F.coalesce("parent", "component").alias("component")), "labels", slim=True)
            release(old)
        left = parent.select(F.col("label").alias("u"), F.col("parent").alias("pu"))
        right = parent.select(F.col("label").alias("v"), F.col("parent").alias("pv"))
        moved = edges.join(left, "u").select("v", "pu").join(right, "v").where("pu <> pv")
        nxt = written(moved.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(), "links", slim=True)
        release(edges, parent)
        edges = nxt
    release(edges)
    if labels is None:
        return links.sparkSession.createDataFrame([], "node long, component long")
    return labels


def forest(mask: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) pairs with the connectivity of a bipartite link mask."""
    rows, cols = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    if not len(rows):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    part = mask[np.ix_(rows, cols)]
    a, b = one[rows], two[cols]
    la, lb, none = a.copy(), b.copy(), np.iinfo(np.int64).max
    while True:
        new_a = np.minimum(la, np.where(part, lb[None, :], none).min(axis=1))
        new_b = np.minimum(lb, np.where(part, new_a[:, None], none).min(axis=0))
        if (new_a == la).all() and (new_b == lb).all():
            break
        la, lb = new_a, new_b
    nodes, roots = np.concatenate([a, b]), np.concatenate([la, lb])
    at = nodes != roots
    return nodes[at], roots[at]
