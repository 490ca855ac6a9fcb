"""Sequence packing: shortest pack first over the histogram of lengths.

A document's ids, with an end id, are cut into full sequences and a rest. Packing looks only at the
histogram of piece lengths (at most ``LENGTH`` numbers): lengths are placed longest first, each on
the packs with most room, many equal packs at once as a pattern with a count. The patterns are then
joined back to pieces by rank: the pieces of one length are numbered 0, 1, ..., and a range of
these numbers belongs to each place of a pattern.

Ranks need no sort and no group in one task: while a partition is encoded it numbers its own pieces
of each length, the written table keeps partition and number, and a running sum over the
partitions' counts, one array for each partition, turns them into ranks. Texts are encoded once and never shuffled.

Defined cases: null and empty texts have the end id alone, so that every row has at least one
piece. A null key stays null and repeated rows are packed one by one. Other columns are never
read; an empty table gives an empty result. Ties between equal lengths are decided by partition and
place in it.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, give_back, map_batches, short_batches, table, written
from tidemark.llm.tokens import WordEncoder, encoder

LENGTH, END = 2048, 1

Pattern = tuple[tuple[int, int], ...]


def pack(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[Pattern, int]]:
    """Patterns ((length, times), ...) with their counts that hold every piece of a histogram."""
    open_packs: list[dict[Pattern, int]] = [{} for _ in range(length + 1)]
    most = 0  # no pack has more room
    for size in sorted((s for s, n in histogram.items() if n), reverse=True):
        n = histogram[size]
        while n:
            while most >= size and not open_packs[most]:
                most -= 1
            if most < size:
                times = min(n, length // size)
                packs = n // times
                pattern, room, used = ((size, times),), length - size * times, packs
                n -= packs * times
            else:
                pattern, packs = next(iter(open_packs[most].items()))
                used = min(packs, n)
                if used == packs:
                    del open_packs[most][pattern]
                else:
                    open_packs[most][pattern] = packs - used
                last, times = pattern[-1]
                pattern = (*pattern[:-1], (last, times + 1)) if last == size else (*pattern, (size, 1))
                room = most - size
                n -= used
            open_packs[room][pattern] = open_packs[room].get(pattern, 0) + used
            most = max(most, room)
    return [(p, n) for packs in open_packs for p, n in packs.items()]


def places(patterns: list[tuple[Pattern, int]]) -> np.ndarray:
    """Rows (length, first rank, packs, first sequence, offset), sorted: where ranks of a length go.

    From its first rank on, every ``packs`` ranks fill one place of the pattern in all its packs.
    """
    rows, rank, sequence = [], defaultdict(int), 0
    for pattern, packs in patterns:
        offset = 0
        for size, times in pattern:
            rows.append((size, rank[size], packs, sequence, offset))
            rank[size] += packs * times
            offset += size * times
        sequence += packs
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


PIECES = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, part int, place long"


def pieces_of(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END) -> DataFrame:
    """The written pieces of all documents, numbered within their partition and length."""
    rows = documents(docs, key, text)
    fields = PIECES.format(rows.schema[key].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        encode, part, seen = encoder(WordEncoder, path), TaskContext.get().partitionId(), np.zeros(length + 1, np.int64)
        for batch in batches:
            at, out = [], []
            whole, ends = encode.encode_all(batch.column(1))
            for row in range(batch.num_rows):
                ids = np.append(whole[ends[row - 1] if row else 0 : ends[row]], np.array([end], encode.width)).astype("<u4")
                for start in range(0, len(ids), length):
                    piece = ids[start : start + length]
                    at.append(row)
                    out.append((start, len(piece), zlib.crc32(piece.tobytes()), len(ids), seen[len(piece)]))
                    seen[len(piece)] += 1
            if at:
                start, size, crc, total, place = (pa.array(np.array(c, np.int64)) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), start, size, crc, total, pa.array(np.full(len(at), part, np.int32)), place], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "place"])

    short_batches(docs.sparkSession)
    return written(rows.mapInArrow(run, fields), "pieces")


def pack_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END) -> DataFrame:
    """Per piece: ``key``, start, length, ids_crc32, doc_tokens, sequence_id and offset."""
    spark = docs.sparkSession
    pieces = pieces_of(docs, path, key, text, length, end)
    counts = written(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `length` rows
    where = spark.sparkContext.broadcast(places(pack(histogram, length)))  # patterns are bounded by the lengths
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).groupBy("part").agg(F.collect_list(F.struct("length", "base")).alias("runs"))

    def dense(batch: pa.RecordBatch) -> dict:
        out = np.zeros((batch.num_rows, length + 1), np.int64)
        for k, row in enumerate(batch.column(1).to_pylist()):
            for run in row:
                out[k, run["length"]] = run["base"]
        return {"b_part": batch.column(0), "bases": list(out)}

    # one row of `length` numbers for each partition of pieces; adaptive execution sends it round or exchanges it by its size
    bases = written(map_batches(runs, dense, "b_part int, bases array<long>"), "bases")
    ranked = pieces.join(bases, pieces["part"] == bases["b_part"]).withColumn("base", F.expr("bases[cast(length as int)]"))
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("place")).alias("rank"))

    def run(batch: pa.RecordBatch) -> dict:
        slots = where.value
        size, rank = batch.column(2).to_numpy(), batch.column(5).to_numpy()
        join = lambda a, b: a.astype(np.uint64) << np.uint64(44) | b.astype(np.uint64)
        at = slots[np.searchsorted(join(slots[:, 0], slots[:, 1]), join(size, rank), side="right") - 1]
        nth = rank - at[:, 1]
        out = {c: batch.column(k) for k, c in enumerate(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])}
        return out | {"sequence_id": pa.array(at[:, 3] + nth % at[:, 2]), "offset": pa.array(at[:, 4] + nth // at[:, 2] * size)}

    kind = pieces.schema["doc_id"].dataType.simpleString()
    out = map_batches(ranked, run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("doc_id", key)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
