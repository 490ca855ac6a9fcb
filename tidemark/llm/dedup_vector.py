"""Near-duplicate vectors: an epsilon grid order join within each label.

Vectors of one label (and one length) are linked when their cosine reaches the threshold; on unit
vectors that is a Euclidean distance of at most ``eps = sqrt(2 - 2 * threshold)``. Projections on
leading principal directions never lengthen a distance, so boxes in a few of these directions
prove blocks distant.

1. Equal vectors form a class with a weight; classes are compared, not copies.
2. The second moments of all unit vectors give the principal directions (a matrix of the vectors'
   length squared; the only thing that reaches the driver).
3. Classes are sorted by label and by grid cells of side eps on the leading directions: the epsilon
   grid order. The sorted sequence is cut into blocks, each with its bounding box.
4. The join descends a tree of sequence intervals: from pairs of intervals to pairs of their
   parts, skipping every pair whose boxes lie more than eps apart. This runs on boxes alone.
5. Pairs of blocks that are left are joined exactly in double precision, those between the same two
   runs of 2^FAN_BITS blocks in one task, so that a block is sent once for each run that it meets. Each
   pair hands back, per class, the weight linked with it, and a forest with the connectivity of its
   links, so that a dense group never becomes all its pairs. Forests are contracted to components.

Vectors travel in the precision in which they came; what leads back to the rows is a 128-bit hash.

Any orthonormal basis gives the same result; the order of floating-point sums can only change how
much is skipped. Where a label's vectors all lie within eps of each other nothing can be skipped
and the work is quadratic in that label's classes, spread over pairs of blocks.

Defined cases: a null label, a null, empty or zero vector and one with a null or non-finite
component link with nothing; vectors of different lengths do not link. Repeated rows are vectors
of their own, linked like copies. A null id is never a representative: its row counts as a vector
of its class, and a class of null ids alone links with nothing. Extra columns are never read; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, map_batches, short_batches, table, written
from tidemark.llm.components import components, forest

THRESHOLD = 0.93
#: Leading directions of the grid order, classes in a block, children of an interval (as bits).
DIRECTIONS, BLOCK, FAN_BITS = 8, 512, 4


def _unit(vectors: np.ndarray) -> np.ndarray:
    big = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / big
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _classes(vectors: DataFrame, key: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """All rows as (id, label, vec), vec null where it can't link; classes (rep, label, dim, vec, weight)."""
    rows = documents(vectors, key, vector, label).toDF("id", "vec", "label")
    sound = F.col("vec").isNotNull() & F.col("label").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("vec", lambda x: x != 0)
    if rows.schema["vec"].dataType.simpleString() != "array<float>":
        rows = rows.withColumn("vec", F.col("vec").cast("array<double>"))
    rows = rows.select("id", "label", F.when(sound, F.col("vec")).alias("vec"))
    grouped = rows.where("vec is not null").groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    return rows, written(grouped.where("rep is not null").select("rep", "label", F.size("vec").alias("dim"), "vec", "weight"), "vectors")


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _bases(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length: its leading principal directions as columns."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims):
                unit = _unit(_matrix(batch.column(1).filter(pa.array(dims == dim)), dim))
                held[dim] = held.get(dim, 0) + unit.T @ unit
        for dim, m in held.items():
            n = dim * dim
            yield pa.RecordBatch.from_pydict({"dim": np.full(n, dim, np.int32), "at": np.arange(n, dtype=np.int32), "x": m.ravel()})

    found = classes.select("dim", "vec").mapInArrow(moments, "dim int, at int, x double").groupBy("dim", "at").agg(F.sum("x").alias("x")).toPandas()
    out = {}
    for dim, part in found.groupby("dim"):
        m = np.zeros(dim * dim)
        m[part["at"].to_numpy()] = part["x"].to_numpy()
        out[int(dim)] = np.linalg.eigh(m.reshape(dim, dim))[1][:, ::-1][:, :DIRECTIONS]
    return out


LO = [f"lo{k}" for k in range(DIRECTIONS)]
HI = [f"hi{k}" for k in range(DIRECTIONS)]


def _blocks(classes: DataFrame, bases: dict[int, np.ndarray], eps: float) -> DataFrame:
    """The epsilon grid order, cut into blocks: label, dim, code (its place in the order), box, and the block's classes."""

    def project(batch: pa.RecordBatch) -> dict:
        dims = batch.column(2).to_numpy()
        y = np.zeros((len(dims), DIRECTIONS))
        for dim in np.unique(dims):
            at = dims == dim
            base = bases[int(dim)]
            y[at, : base.shape[1]] = _unit(_matrix(batch.column(3).filter(pa.array(at)), dim)) @ base
        return {"rep": batch.column(0), "label": batch.column(1), "dim": batch.column(2), "vec": batch.column(3), "weight": batch.column(4), "y": list(y), "cell": list(np.floor(y / eps).astype(np.int32))}

    label, kind = classes.schema["label"].dataType.simpleString(), classes.schema["vec"].dataType.simpleString()
    width = "<f4" if kind == "array<float>" else "<f8"
    placed = map_batches(classes, project, f"rep long, label {label}, dim int, vec {kind}, weight long, y array<double>, cell array<int>")
    order = ["label", "dim", "cell", "rep"]
    parts = max(1, int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = written(placed, "placed").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    fields = f"label {label}, dim int, part int, n int, {', '.join(f'{c} double' for c in LO + HI)}, reps binary, weights binary, vecs binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, held, of = TaskContext.get().partitionId(), 0, [], None

        def block() -> pa.RecordBatch:
            y = np.stack([r[3] for r in held])
            low, high = y.min(axis=0), y.max(axis=0)
            out = {"label": [of[0]], "dim": pa.array([of[1]], pa.int32()), "part": pa.array([part], pa.int32()), "n": pa.array([n], pa.int32())}
            out |= {c: [low[k]] for k, c in enumerate(LO)} | {c: [high[k]] for k, c in enumerate(HI)}
            out["reps"] = [np.array([r[0] for r in held], "<i8").tobytes()]
            out["weights"] = [np.array([r[1] for r in held], "<i8").tobytes()]
            out["vecs"] = [np.stack([r[2] for r in held]).astype(width).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) if not isinstance(out[f.name], pa.Array) else out[f.name] for f in schema], schema=schema)

        for batch in batches:
            labels, dims = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            reps, weights = batch.column(0).to_pylist(), batch.column(4).to_pylist()
            vecs, ys = batch.column(3), batch.column(5)
            for k in range(batch.num_rows):
                mine = (labels[k], dims[k])
                if held and (mine != of or len(held) == BLOCK):
                    yield block()
                    n, held = n + 1, []
                of = mine
                held.append((reps[k], weights[k], vecs[k].values.to_numpy(), ys[k].values.to_numpy()))
        if held:
            yield block()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    struct = StructType.fromDDL(fields)
    schema = to_arrow_schema(struct)
    short_batches(classes.sparkSession)
    blocks = written(placed.mapInArrow(cut, struct), "blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    first = blocks.groupBy("part").agg(F.count(F.lit(1)).alias("m")).select("part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("first"))
    return blocks.join(first, "part").withColumn("code", F.col("first") + F.col("n")).drop("first")


def _pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs (a, b), a <= b, of block codes of one label and length whose boxes lie within eps."""
    leaves = written(blocks.select("label", "dim", "code", *LO, *HI), "boxes")
    bits = max(1, int(leaves.agg(F.max("code")).first()[0] or 0).bit_length())
    levels = math.ceil(bits / FAN_BITS)

    def nodes(level: int, side: str) -> DataFrame:
        at = leaves.withColumn("code", F.shiftright("code", level * FAN_BITS))
        if level:
            at = at.groupBy("label", "dim", "code").agg(*[F.min(c).alias(c) for c in LO], *[F.max(c).alias(c) for c in HI])
        return at.select(F.col("label").alias(f"label_{side}"), F.col("dim").alias(f"dim_{side}"), F.col("code").alias(side), F.shiftright("code", FAN_BITS).alias(f"up_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in LO + HI])

    apart = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"{lo}_a") - F.col(f"{hi}_b"), F.col(f"{lo}_b") - F.col(f"{hi}_a")), 2) for lo, hi in zip(LO, HI, strict=True)), F.lit(0.0))
    pairs = leaves.select("label", "dim", F.shiftright("code", levels * FAN_BITS).alias("pa")).distinct().withColumn("pb", F.col("pa"))
    for level in range(levels - 1, -1, -1):
        a, b = nodes(level, "a"), nodes(level, "b")
        half = pairs.join(a, (pairs["label"] == a["label_a"]) & (pairs["dim"] == a["dim_a"]) & (pairs["pa"] == a["up_a"]))
        whole = half.join(b, (half["label"] == b["label_b"]) & (half["dim"] == b["dim_b"]) & (half["pb"] == b["up_b"]) & (half["a"] <= b["b"]))
        pairs = written(whole.where(apart <= eps * eps + 1e-9).select("label", "dim", F.col("a").alias("pa"), F.col("b").alias("pb")), "intervals")
    return pairs.select("dim", F.col("pa").alias("a"), F.col("pb").alias("b"))


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which cosines of the rows of x and y reach the threshold, in double precision."""
    ux, uy = _unit(x), _unit(y)
    cosine = ux @ uy.T
    mask = cosine >= threshold
    for i, j in zip(*np.nonzero(np.abs(cosine - threshold) < 1e-12), strict=True):  # the plain formula decides at the edge
        mask[i, j] = np.dot(x[i], y[j]) / (np.sqrt(np.dot(x[i], x[i])) * np.sqrt(np.dot(y[j], y[j]))) >= threshold
    return mask


def _joined(blocks: DataFrame, pairs: DataFrame, threshold: float, width: str) -> DataFrame:
    """(u, v, n): links of class u weigh n where v is null; else u and v are connected."""
    pairs = pairs.withColumn("run_a", F.shiftright("a", FAN_BITS)).withColumn("run_b", F.shiftright("b", FAN_BITS))
    ends = pairs.select("run_a", "run_b", F.col("a").alias("end")).unionByName(pairs.select("run_a", "run_b", F.col("b").alias("end"))).distinct()
    sent = ends.join(blocks.select("code", "reps", "weights", "vecs"), F.col("end") == F.col("code"))
    rows = pairs.select("run_a", "run_b", F.col("a").alias("code"), F.col("b").alias("other"), "dim").unionByName(sent.select("run_a", "run_b", "code", F.lit(-1).cast("long").alias("other"), "reps", "weights", "vecs"), allowMissingColumns=True)
    names = ["run_a", "run_b", "other", "code", "dim", "reps", "weights", "vecs"]

    def links(held: dict, a: int, b: int, dim: int) -> pa.RecordBatch | None:
        (ra, wa, xa), (rb, wb, xb) = held[a], held[b]
        mask = linked(xa.reshape(-1, dim), xb.reshape(-1, dim), threshold)
        if a == b:
            np.fill_diagonal(mask, False)
        counts = [(ra, mask @ wb)] + ([] if a == b else [(rb, mask.T @ wa)])
        u = np.concatenate([r[c > 0] for r, c in counts])
        if not len(u):
            return None
        n = np.concatenate([c[c > 0] for _, c in counts])
        node, root = forest(mask, ra, rb)
        weight = np.arange(len(u) + len(node)) < len(u)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([u, node])), pa.array(np.concatenate([np.zeros_like(u), root]), mask=weight), pa.array(np.concatenate([n, np.zeros_like(node)]))], names=["u", "v", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = None, {}
        for batch in batches:
            run_a, run_b, other, code = (batch.column(k).to_pylist() for k in range(4))
            for k in range(batch.num_rows):
                if (run_a[k], run_b[k]) != of:
                    of, held = (run_a[k], run_b[k]), {}
                if other[k] < 0:  # a block; they come before the pairs
                    held[code[k]] = tuple(np.frombuffer(batch.column(5 + c)[k].as_py(), t).astype(as_) for c, t, as_ in ((0, "<i8", np.int64), (1, "<i8", np.int64), (2, width, np.float64)))
                elif found := links(held, code[k], other[k], batch.column(4)[k].as_py()):
                    yield found

    short_batches(blocks.sparkSession)
    return rows.select(*names).repartition("run_a", "run_b").sortWithinPartitions("run_a", "run_b", "other").mapInArrow(run, "u long, v long, n long")


def vector_dedup(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``key``, n_links, component_id and kept; see the module's text."""
    eps = math.sqrt(max(0.0, 2 - 2 * threshold))
    rows, classes = _classes(vectors, key, vector, label)
    bases = _bases(classes)
    blocks = _blocks(classes, bases, eps)
    width = "<f4" if classes.schema["vec"].dataType.simpleString() == "array<float>" else "<f8"
    out = written(_joined(blocks, _pairs(blocks, eps), threshold, width), "vector-links")
    weights = out.where("v is null").groupBy("u").agg(F.sum("n").alias("linked"))
    found = components(out.where("v is not null").select("u", "v"))
    known = classes.join(weights, classes["rep"] == weights["u"], "left").join(found, classes["rep"] == found["node"], "left")
    prints = [F.xxhash64("vec", F.size("vec")), F.xxhash64(F.lit("second"), "vec")]
    known = known.select(F.col("label").alias("c_label"), *[p.alias(f"c_{k}") for k, p in enumerate(prints)], (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    known = written(known, "vector-classes")
    plain = rows.select("id", "label", *[F.when(F.col("vec").isNotNull(), p).alias(f"p_{k}") for k, p in enumerate(prints)])
    joined = plain.join(known, (F.col("p_0") == F.col("c_0")) & (F.col("p_1") == F.col("c_1")) & (F.col("label") == F.col("c_label")), "left")
    component = F.coalesce("component", "id")
    return joined.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op10_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup(table(spark, sf_dir, "embeddings"))


#: The same rows in DuckDB, all pairs of a label against each other.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), r(u, w) AS (SELECT u, w FROM l UNION SELECT r.u, l.w FROM r JOIN l ON r.w = l.u),
n AS (SELECT u, COUNT(*) AS n FROM l GROUP BY 1), c AS (SELECT u, MIN(w) AS m FROM r GROUP BY 1)
SELECT vec_id, COALESCE(n, 0) AS n_links, LEAST(vec_id, COALESCE(m, vec_id)) AS component_id, vec_id = LEAST(vec_id, COALESCE(m, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.u = vec_id LEFT JOIN c ON c.u = vec_id
"""
