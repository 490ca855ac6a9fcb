"""Near-duplicate documents: MinHash signatures, a multi-index Hamming join, links on full sets.

A document's set holds its distinct shingles of five words. Its signature has K = 64 MinHash
values of b = 16 bits. The signature distance of two documents is the number of places in which
they differ. The join returns *all* pairs within distance T = 31: the signature is split into
M = 16 chunks of four places, and of at most 31 differing places some chunk holds at most
floor(31 / 16) = 1 (pigeonhole); enumerating the allowed error of a chunk, that is leaving out one
of its places in turn, gives 64 keys a document, one of which such a pair must share. Two sets of
similarity 0.75 differ in 16 places on average with a standard deviation of 3.5, so that less than
one pair in 10^4 at the very threshold lies beyond T, and fewer the more similar they are. Every
link is confirmed on the full sets: ``100 * intersection >= 75 * union``.

Links are contracted as they are confirmed, so that a group of copies never expands into pairs:

* documents with equal sets form a class, represented by its smallest id;
* a key shared by two classes is a pair; of a key shared by more, each class is paired with the
  key's *pivot* (the first of a fixed shuffled order, so that the keys of a group mostly have one
  pivot and pairs repeat). Pairs within T are confirmed on full sets and contracted;
* a key whose classes now are one component is done. What is left (classes that share a key but not
  a component, say documents with one passage in common) can only be linked if they share one of
  the rarest ``n - ceil(0.75 n) + 1`` shingles of either set, whatever the order of rarity; the order
  comes from a count of shingles in a table of fixed size. Groups of such a shingle of at most
  ``SMALL`` classes are paired whole, larger ones with a pivot again; confirmed and contracted;
* of a large group that still lies in several components, each class outside the largest one is
  compared on full sets with that component and with the others outside it, in blocks, once however
  many shingles bring them together.

Every pair of classes that shares a key is so confirmed, joined through others, or proven to be no
link; work beyond rows in proportion to the input is done only for classes that share rare
shingles with a component and are linked to none of its pivots. Blocks bound what one task holds, in
classes and in bytes.

Defined cases: null or wordless text has an empty set and is linked with nothing; fewer than five
words are one shingle. Rows that repeat an id are members of their sets' classes like any other
row. A row with a null id takes its class's component and is kept only if that is null as well.
Extra columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, gathered, map_batches, release, short_batches, table, texts_of, written
from tidemark.llm.components import components, forest

WORDS = 5
PLACES, CHUNK, LIMIT = 64, 4, 31
CHUNKS = PLACES // CHUNK
PERCENT = 75
#: Classes of a shingle that are paired whole; classes and bytes of sets in a block beyond.
SMALL, BLOCK, BLOCK_BYTES = 32, 2048, 4 << 20
#: Slots of the table of shingle counts, one byte each.
SLOTS = 1 << 20

_MASK = (1 << 64) - 1


def _words64(seed: str, n: int) -> np.ndarray:
    """n odd 64-bit numbers that depend on the seed alone."""
    return np.array([int.from_bytes(hashlib.blake2b(f"{seed}{i}".encode(), digest_size=8).digest(), "little") | 1 for i in range(n)], dtype=np.uint64)


_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, WORDS - 1 - k, 1 << 64)) for k in range(WORDS)]
_HASH = _words64("minhash", PLACES)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingles(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text."""
    words = text.encode().lower().split()  # of bytes: only A-Z is lowered, only 0x20 and 0x09-0x0D part words
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    whole = each[:n] * _POWERS[0]
    for k in range(1, WORDS):
        whole = whole + each[k : k + n] * _POWERS[k]
    return np.unique(_mixed(whole))


def print_of(items: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that stand for a set; equal sets have equal prints."""
    return int(items.sum(dtype=np.uint64).view(np.int64)), int(_mixed(items + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64).view(np.int64))


def signature(items: np.ndarray) -> bytes:
    low = np.full(PLACES, _MASK, np.uint64)
    for at in range(0, len(items), 4096):
        np.minimum(low, (items[at : at + 4096, None] * _HASH).min(axis=0), out=low)
    return (low >> np.uint64(8)).astype("<u2").tobytes()


def keys_of(signatures: np.ndarray) -> np.ndarray:
    """(documents, PLACES) keys: for each chunk and each place left out, the other places of it."""
    chunks = signatures.reshape(-1, CHUNKS, CHUNK).astype(np.uint64)
    out = np.empty((len(signatures), CHUNKS, CHUNK), np.uint64)
    for skip in range(CHUNK):
        key = np.zeros(chunks.shape[:2], np.uint64)
        for place in range(CHUNK):
            if place != skip:
                key = (key << np.uint64(16)) | chunks[:, :, place]
        out[:, :, skip] = key
    out ^= np.arange(PLACES, dtype=np.uint64).reshape(CHUNKS, CHUNK) << np.uint64(48)
    return out.reshape(-1, PLACES).view(np.int64)


def _sigs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(-1, PLACES)


def sets_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: doc_id, n_shingles, the print (p, q) and the signature; null where the set is empty."""

    def run(batch: pa.RecordBatch) -> dict:
        out = {"doc_id": batch.column(0), "n_shingles": [], "p": [], "q": [], "sig": []}
        for value in texts_of(batch.column(1)):
            items = shingles(value)
            out["n_shingles"].append(len(items))
            p, q = print_of(items) if len(items) else (None, None)
            out["p"].append(p)
            out["q"].append(q)
            out["sig"].append(signature(items) if len(items) else None)
        return out

    return map_batches(documents(docs, key, text), run, "doc_id long, n_shingles long, p long, q long, sig binary")


def _keys(reps: DataFrame) -> DataFrame:
    """(key, rep): PLACES rows for each class."""

    def run(batch: pa.RecordBatch) -> dict:
        keys = keys_of(_sigs(batch.column(1).to_pylist()))
        return {"key": pa.array(keys.ravel()), "rep": pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), PLACES))}

    # every class makes PLACES rows: many small tasks, lest a task's counts of keys fill its memory
    parts = max(1, int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return map_batches(reps.select("rep", "sig").repartition(parts, "rep"), run, "key long, rep long")


class _Bitmap:
    """Ids as bits of a hash, of fixed size: a filter before an exchange, exact in what it lets pass last."""

    BITS = 1 << 23

    def __init__(self, ids: DataFrame):
        bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {self.BITS}) & 63 as int))")
        rows = ids.select(F.shiftright(F.pmod(F.xxhash64("id"), F.lit(self.BITS)), 6).alias("word"), bit.alias("bit"))
        self.words = ids.sparkSession.sparkContext.broadcast(gathered(rows.groupBy("word").agg(F.bit_or("bit").alias("bits")), self.BITS // 64))

    def __call__(self, docs: DataFrame, key: str) -> DataFrame:
        held, bits = self.words, self.BITS

        @F.pandas_udf("boolean")
        def there(place: pd.Series) -> pd.Series:
            at = place.to_numpy()
            return pd.Series((held.value[at >> 6] >> (at & 63)) & 1 == 1)

        return docs.where(F.col(key).isNotNull()).where(there(F.pmod(F.xxhash64(key), F.lit(bits))))


def grouped(rows: DataFrame, keys: int, run) -> DataFrame:
    """(u, v) of ``run`` over the record batches of each group; the first ``keys`` columns name a group.

    Rows are exchanged and sorted by the group, so that one group is held at a time.
    """
    names = rows.columns[:keys]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        of, out = None, ([], [])

        def close() -> None:
            u, v = run(held)
            out[0].extend(u)
            out[1].extend(v)

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.array(x, np.int64)) for x in out], names=["u", "v"])

        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy() for c in range(keys)], axis=1)
            starts = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(axis=1)])
            for start, end in zip(starts, [*starts[1:], len(marks)], strict=True):
                mine = tuple(marks[start].tolist())
                if held and mine != of:
                    close()
                    held.clear()
                of = mine
                held.append(batch.slice(start, end - start))
            if len(out[0]) > 10_000:
                yield batch_of()
                out[0].clear(), out[1].clear()
        if held:
            close()
        if out[0]:
            yield batch_of()

    short_batches(rows.sparkSession)
    return rows.repartition(*names).sortWithinPartitions(*names).mapInArrow(over, "u long, v long")


def _near(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Those pairs of classes (u, v, cu, cv) whose signatures are within the limit and whose sizes allow a link."""
    a = reps.select(F.col("rep").alias("u"), F.col("sig").alias("a"), F.col("n_shingles").alias("na"))
    b = reps.select(F.col("rep").alias("v"), F.col("sig").alias("b"), F.col("n_shingles").alias("nb"))
    both = pairs.join(a, "u").join(b, "v").where(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")).select("u", "v", "cu", "cv", "a", "b")

    def run(batch: pa.RecordBatch) -> dict:
        keep = pa.array((_sigs(batch.column(4).to_pylist()) != _sigs(batch.column(5).to_pylist())).sum(axis=1) <= LIMIT)
        return {c: batch.column(k).filter(keep) for k, c in enumerate(("u", "v", "cu", "cv"))}

    return map_batches(both, run, "u long, v long, cu long, cv long")


def _linked(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """(u, v): components cu and cv of those pairs of classes (u, v, cu, cv) that are links on full sets."""
    a, b = items.select(F.col("rep").alias("u"), F.col("items").alias("a")), items.select(F.col("rep").alias("v"), F.col("items").alias("b"))
    both = pairs.join(a, "u").join(b, "v").select("cu", "cv", "a", "b")

    def run(batch: pa.RecordBatch) -> dict:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            shared = len(np.intersect1d(one, two, assume_unique=True))
            keep.append(100 * shared >= PERCENT * (len(one) + len(two) - shared))
        mask = pa.array(keep, pa.bool_())
        return {"u": batch.column(0).filter(mask), "v": batch.column(1).filter(mask)}

    return map_batches(both, run, "u long, v long").distinct()


def _merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels (rep, comp) after components joined by ``edges`` (u, v) became one."""
    found = components(edges)
    out = written(labels.join(found, labels["comp"] == found["node"], "left").select("rep", F.coalesce("component", "comp").alias("comp")), "labels", slim=True)
    release(found, labels)
    return out


def _items(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, items): the full sets of ``reps`` (rep, p, q) as bytes, from ``docs`` (doc_id, text)."""
    texts = _Bitmap(reps.select(F.col("rep").alias("id")))(docs, "doc_id").join(reps, F.col("doc_id") == F.col("rep"))

    def run(batch: pa.RecordBatch) -> dict:
        items = [shingles(t) for t in texts_of(batch.column(0))]
        right = [len(x) > 0 and print_of(x) == mark for x, mark in zip(items, zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True), strict=True)]
        # a row under a repeated id may hold another text
        return {"rep": batch.column(3).filter(pa.array(right, pa.bool_())), "items": [x.tobytes() for x, ok in zip(items, right, strict=True) if ok]}

    return map_batches(texts.select("text", "p", "q", "rep"), run, "rep long, items binary").dropDuplicates(["rep"])


def _mixed_groups(members: DataFrame, key: str) -> DataFrame:
    """(``key``, n) of the groups of ``members`` (``key``, rep, comp) that lie in several components."""
    return members.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select(F.col(key).alias("k"), "n")


def _rarity(full: DataFrame):
    """Broadcast table of one byte a slot that grows with the number of shingles in it; 1 stands for one shingle."""

    def run(batch: pa.RecordBatch) -> dict:
        whole = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(0)])
        slots, n = np.unique(whole & np.uint64(SLOTS - 1), return_counts=True)
        return {"slot": pa.array(slots.view(np.int64)), "n": pa.array(n)}

    counts = map_batches(full.select("items"), run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    code = F.expr("cast(if(n < 64, n, least(127, 64 + floor(4 * log2(n / 64)))) as long)")
    packed = counts.select(F.expr("slot div 8").alias("word"), F.expr("cast(8 * (slot % 8) as int)").alias("at"), code.alias("code"))
    words = gathered(packed.groupBy("word").agg(F.expr("bit_or(shiftleft(code, at))").alias("codes")), SLOTS // 8)
    return full.sparkSession.sparkContext.broadcast(words.astype("<i8").view(np.uint8))


def _prefixes(full: DataFrame) -> DataFrame:
    """(token, rep, comp): the rarest shingles of each set (rep, comp, items) that two linked sets must share one of."""
    codes = _rarity(full)

    def run(batch: pa.RecordBatch) -> dict:
        tokens, counts = [], []
        for x in batch.column(2):
            items = np.frombuffer(x.as_buffer(), np.uint64)
            code = codes.value[items & np.uint64(SLOTS - 1)]
            first = np.lexsort((items, code))[: len(items) - -(-PERCENT * len(items) // 100) + 1]
            mine = items[first[code[first] > 1]]  # a shingle of one set is shared with none
            tokens.append(mine)
            counts.append(len(mine))
        return {"token": pa.array(np.concatenate(tokens).view(np.int64))} | {c: pa.array(np.repeat(batch.column(k).to_numpy(zero_copy_only=False), counts)) for k, c in enumerate(("rep", "comp"))}

    return map_batches(full, run, "token long, rep long, comp long")


def _whole(groups: DataFrame) -> DataFrame:
    """Pairs (u, v, cu, cv) across components of small groups (token, rep, comp, n), of large ones those with a pivot."""
    small, large = groups.where(f"n <= {SMALL}"), groups.where(f"n > {SMALL}")
    other = small.select("token", F.col("rep").alias("v"), F.col("comp").alias("cv"))
    pairs = small.select("token", F.col("rep").alias("u"), F.col("comp").alias("cu")).join(other, "token").where("u < v and cu <> cv").select("u", "v", "cu", "cv")
    pivots = large.groupBy("token").agg(F.min_by(F.struct("rep", "comp"), F.xxhash64("rep", F.lit(13))).alias("p")).select("token", F.col("p.rep").alias("p"), F.col("p.comp").alias("cp"))
    star = large.join(pivots, "token").where("comp <> cp").select(F.least("rep", "p").alias("u"), F.greatest("rep", "p").alias("v"), F.when(F.col("rep") < F.col("p"), F.col("comp")).otherwise(F.col("cp")).alias("cu"), F.when(F.col("rep") < F.col("p"), F.col("cp")).otherwise(F.col("comp")).alias("cv"))
    return pairs.unionByName(star).distinct()


def _shared_counts(items: list[np.ndarray], split: int) -> np.ndarray:
    """Sizes of the intersections of each of the first ``split`` sets with each of the others."""
    whole = np.concatenate(items)
    of = np.repeat(np.arange(len(items)), [len(x) for x in items])
    order = np.argsort(whole, kind="stable")
    whole, of = whole[order], of[order]
    first = np.r_[True, whole[1:] != whole[:-1]]
    column = np.cumsum(first) - 1
    often = np.bincount(column) > 1
    place = np.cumsum(often) - 1
    keep = often[column]
    column, of = place[column[keep]], of[keep]
    counts = np.zeros((split, len(items) - split), np.float32)
    width = max(64, (4 << 20) // len(items))  # a matrix of 16 MB
    bounds = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else 0) + width + 1, width))
    for k, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if hi > lo:
            m = np.zeros((len(items), width), np.float32)
            m[of[lo:hi], column[lo:hi] - k * width] = 1
            counts += m[:split] @ m[split:].T
    return counts


def _across(left: DataFrame, right: DataFrame) -> DataFrame:
    """(u, v): components linked on full sets between the ``left`` and ``right`` rows (key, rep, comp, items) of a key.

    Each block of left classes meets each block of right ones and hands back a forest of their links.
    """

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("items")).alias("bytes"))
        return sizes.select("key", F.expr(f"cast(greatest(ceil(n / {BLOCK}), ceil(bytes / {BLOCK_BYTES})) as long)").alias(name))

    sizes = blocks(left, "lefts").join(blocks(right, "rights"), "key")
    place = "pmod(xxhash64(rep, 5), {})"
    a = left.join(sizes, "key").withColumn("i", F.expr(place.format("lefts"))).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rights") - 1))).withColumn("asks", F.lit(True))
    b = right.join(sizes, "key").withColumn("j", F.expr(place.format("rights"))).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lefts") - 1))).withColumn("asks", F.lit(False))
    names = ["key", "i", "j", "asks", "comp", "items"]

    def link(batches: list[pa.RecordBatch]) -> tuple:
        asks = np.concatenate([b.column(3).to_numpy(zero_copy_only=False) for b in batches])
        comp = np.concatenate([b.column(4).to_numpy() for b in batches])
        items = [np.frombuffer(x.as_buffer(), np.uint64) for b in batches for x in b.column(5)]
        one, two = np.flatnonzero(asks), np.flatnonzero(~asks)
        if not len(one) or not len(two):
            return [], []
        shared = _shared_counts([items[k] for k in (*one, *two)], len(one))
        size = np.array([len(x) for x in items], np.float32)
        mask = (100 + PERCENT) * shared >= PERCENT * (size[one][:, None] + size[two][None, :])
        return forest(mask & (comp[one][:, None] != comp[two][None, :]), comp[one], comp[two])

    return grouped(a.select(*names).unionByName(b.select(*names)), 3, link)


def _rest(held: DataFrame, labels: DataFrame, full: DataFrame) -> DataFrame:
    """(u, v): links between components of large groups, ``held``: token, rep; ``labels``: rep, comp; ``full``: rep, items.

    A group's largest component is its major. Classes outside it ask: they meet the major, and each
    other, once for all groups with that major.
    """
    members = written(held.join(labels, "rep").select("token", "rep", "comp"), "members", slim=True)
    each = members.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("token").agg(F.max(F.struct("c", "comp")).alias("best"), F.count(F.lit(1)).alias("parts"))
    major = each.where("parts > 1").select("token", F.col("best.comp").alias("key"))
    asking = written(members.join(major, "token").where("comp <> key").select("key", "rep", "comp").distinct(), "asking", slim=True)
    bodies = members.select(F.col("comp").alias("key"), "rep", "comp").distinct().join(asking.select("key").distinct(), "key", "left_semi")
    sets = full.select("rep", "items")
    left = written(asking.join(sets, "rep"), "left")
    right = written(asking.unionByName(bodies).join(sets, "rep"), "right")
    out = written(_across(left, right).distinct(), "edges", slim=True)
    release(members, asking, left, right)
    return out


def components_of(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, comp) of the classes that share a key with another; see the module's text.

    ``reps``: rep, n_shingles, p, q, sig; ``docs``: doc_id, text.
    """
    keyed = _keys(reps)
    counted = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("u"), F.max("rep").alias("v"), F.min_by("rep", F.xxhash64("rep", F.lit(3))).alias("pivot")).where("n > 1")
    counted = written(counted, "keys")
    many = counted.where("n > 2").select(F.col("key").alias("k"), "pivot")
    shared = written(keyed.join(many, F.col("key") == F.col("k")).select("key", "rep", "pivot"), "shared")
    star = shared.where("rep <> pivot").select(F.least("rep", "pivot").alias("u"), F.greatest("rep", "pivot").alias("v"))
    pairs = counted.where("n = 2").select("u", "v").unionByName(star).distinct().select("u", "v", F.col("u").alias("cu"), F.col("v").alias("cv"))
    pairs = written(_near(pairs, reps), "near", slim=True)
    ids = pairs.select(F.col("u").alias("rep")).unionByName(pairs.select(F.col("v").alias("rep"))).unionByName(shared.select("rep")).distinct()
    ids = written(ids, "ids", slim=True)
    wanted = written(reps.join(ids, "rep", "left_semi").select("rep", "p", "q"), "wanted", slim=True)
    items = written(_items(wanted, docs), "items")
    labels = _merged(written(ids.select("rep", F.col("rep").alias("comp")), "labels", slim=True), _linked(pairs, items))
    release(counted, pairs, ids, wanted)

    members = shared.join(labels, "rep").select("key", "rep", "comp")
    left = written(members.join(_mixed_groups(members, "key"), F.col("key") == F.col("k")).select("rep", "comp").distinct(), "open", slim=True)
    release(shared)
    if left.isEmpty():
        return labels
    full = written(items.join(left, "rep").select("rep", "comp", "items"), "full")
    release(items)
    tokens = written(_prefixes(full), "tokens")
    held = written(tokens.join(_mixed_groups(tokens, "token"), F.col("token") == F.col("k")).select("token", "rep", "comp", "n"), "held", slim=True)
    release(tokens)
    labels = _merged(labels, _linked(_near(_whole(held), reps), full))
    large = held.where(f"n > {SMALL}").select("token", "rep")
    if not large.isEmpty():
        labels = _merged(labels, _rest(large, labels, full))
    release(held, full)
    return labels


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, n_shingles, component_id (smallest id reachable by links) and kept."""
    rows = documents(docs, key, text).toDF("doc_id", "text")
    sets = written(sets_of(rows, "doc_id", "text"), "sets")
    classes = sets.where("p is not null and doc_id is not null").groupBy("n_shingles", "p", "q").agg(F.min("doc_id").alias("rep"), F.min_by("sig", "doc_id").alias("sig"))
    reps = written(classes, "classes")
    found = components_of(reps, rows).where("rep <> comp")
    labelled = reps.join(found.toDF("r", "component"), F.col("rep") == F.col("r"), "left").select(F.col("p").alias("cp"), F.col("q").alias("cq"), F.col("n_shingles").alias("cn"), F.coalesce("component", "rep").alias("component"))
    joined = sets.join(labelled, (F.col("p") == F.col("cp")) & (F.col("q") == F.col("cq")) & (F.col("n_shingles") == F.col("cn")), "left")
    component = F.coalesce("component", "doc_id")
    return joined.select(F.col("doc_id").alias(key), "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


#: The same rows in DuckDB, from an index of all shingles.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ') || '#' || CAST(len(w) AS VARCHAR)]
    ELSE list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END) AS x FROM d
), n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS u, b.doc_id AS w, COUNT(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT p.u, p.w FROM p JOIN n a ON a.doc_id = p.u JOIN n b ON b.doc_id = p.w WHERE 100 * k >= 75 * (a.n + b.n - k)),
r(u, w) AS (SELECT u, w FROM l UNION SELECT r.u, l.w FROM r JOIN l ON r.w = l.u), c AS (SELECT u, MIN(w) AS m FROM r GROUP BY 1)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, LEAST(d.doc_id, COALESCE(m, d.doc_id)) AS component_id, d.doc_id = LEAST(d.doc_id, COALESCE(m, d.doc_id)) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.u = d.doc_id
"""
