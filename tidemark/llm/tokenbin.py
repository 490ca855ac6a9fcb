"""Token ids in shards, with a minimal perfect hash index for access by document key.

File format. A written set of shards is a Parquet table whose rows are *segments*; range
partitioning by key makes every shard (one file of one task) a run of ascending keys:

=========== ======= ==============================================================
place       long    shard * 2^32 + number of the segment in its shard
first, last long    smallest and largest key of the segment (null: null keys)
local       long    ids in the shard before this segment
width       int     bytes of an id: 2 if the vocabulary fits, else 4
docs        int     documents in the segment
tokens      long    ids in the segment
payload     binary  the ids of all documents, one after another, little-endian
keys        binary  int64 keys in document order (null keys stored as 0)
present     binary  one byte for each document: 0 marks a null key
since       long    occurrences of the first key in the shard before this segment
seed        long    seed of the hash function
pilots      binary  uint32 for each bucket of the hash function
slots       binary  per slot: fingerprint u4, document u4, start u8, count u4
=========== ======= ==============================================================

Each value stands in a page of its own (one row a page), so that a reader that names a place seeks
to that payload by the file's page index.

The index is a minimal perfect hash function of the segment's n documents onto n slots (hash and
displace: buckets of four documents on average, the largest first, each with the first pilot that
puts its documents into free slots; buckets of one take the free slots left; a seed under which two
hashes meet is given up for the next). A lookup finds the segment of a key in the directory of first
and last keys, hashes the key, reads its bucket's pilot and one slot, and compares the stored
fingerprint, so that a key that is not there is refused with probability 1 - 2^-32 before the stored
key itself is compared. Rows that repeat a key are told apart by their occurrence number in the shard,
which is part of the hashed key.

Writing is one Spark job that commits files atomically; a lost executor repeats tasks. Only one
total for each shard reaches the driver.

Defined cases: null and empty texts have the end id alone. Null keys sort first, among themselves
by text, and count as occurrences of one null key; so do repeated keys, which many shards may
share. Other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructType

from tidemark.llm.common import documents, give_back, map_batches, short_batches, table, written
from tidemark.llm.tokens import WordEncoder, encoder

END = 2
#: Documents and payload bytes from which a segment is closed.
SEGMENT_DOCS, SEGMENT_BYTES = 2048, 1 << 20

INT, LONG, BINARY = IntegerType(), LongType(), BinaryType()
FORMAT = StructType()
for _name, _type in (("place", LONG), ("first", LONG), ("last", LONG), ("local", LONG), ("width", INT), ("docs", INT), ("tokens", LONG), ("payload", BINARY), ("keys", BINARY), ("present", BINARY), ("since", LONG), ("seed", LONG), ("pilots", BINARY), ("slots", BINARY)):
    FORMAT.add(_name, _type)
#: What a reader of documents needs of a segment.
OPENED = ["place", "local", "width", "payload", "keys", "present", "since", "seed", "pilots", "slots"]
SLOT = np.dtype([("print", "<u4"), ("doc", "<u4"), ("start", "<u8"), ("count", "<u4")])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(keys: np.ndarray, present: np.ndarray, nth: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of (key or null, occurrence)."""
    x = _mix(keys.astype(np.int64).view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) % (1 << 64)))
    return _mix(x + nth.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + present.astype(np.uint64))


def _slot(h: np.ndarray, pilot: np.ndarray, n: int) -> np.ndarray:
    return (_mix(h ^ _mix(pilot.astype(np.uint64) + np.uint64(1))) % np.uint64(n)).astype(np.int64)


#: A pilot with this bit names its slot outright.
DIRECT = np.uint32(1 << 31)


def buckets_of(n: int) -> int:
    return n // 4 + 1


def build(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilots of a minimal perfect hash function of distinct hashes, and each one's slot."""
    n = len(h)
    pilots, taken, where = np.zeros(buckets_of(n), np.uint32), np.zeros(n, bool), np.zeros(n, np.int64)
    bucket = (h >> np.uint64(33)) % np.uint64(len(pilots))
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(bucket[order].astype(np.int64)) != 0])
    groups = np.split(order, starts[1:])
    single = []
    for group in sorted(groups, key=len, reverse=True):
        if len(group) == 1:
            single.append(group[0])
            continue
        pilot = 0
        while True:
            tries = np.arange(pilot, pilot + 32, dtype=np.uint32)
            slots = _slot(h[group][None, :], tries[:, None], n)
            ordered = np.sort(slots, axis=1)
            good = ~taken[slots].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                first = int(np.argmax(good))
                pilots[bucket[group[0]]], where[group] = tries[first], slots[first]
                taken[slots[first]] = True
                break
            pilot += 32
    for doc, slot in zip(single, np.flatnonzero(~taken), strict=True):
        pilots[bucket[doc]], where[doc] = DIRECT | np.uint32(slot), slot
    return pilots, where


def find(pilots: np.ndarray, slots: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The slot records of hashes; a record whose fingerprint differs has count 0 and document -1."""
    pilot = pilots[((h >> np.uint64(33)) % np.uint64(len(pilots))).astype(np.int64)]
    at = np.where(pilot & DIRECT, (pilot & ~DIRECT).astype(np.int64) % len(slots), _slot(h, pilot, len(slots)))
    found = slots[at].copy()
    found["doc"][found["print"] != (h & np.uint64(0xFFFFFFFF))] = 0xFFFFFFFF
    return found


def _occurrences(keys: np.ndarray, present: np.ndarray, since: int = 0) -> np.ndarray:
    """How often each (sorted) key came before; the first one has come ``since`` times."""
    place = np.arange(len(keys))
    new = np.r_[True, (keys[1:] != keys[:-1]) | (present[1:] != present[:-1])]
    nth = place - np.maximum.accumulate(np.where(new, place, 0))
    return nth + np.where(np.cumsum(new) == 1, since, 0)


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """Encode all documents, in ascending order of their keys, into shards; returns the written table."""
    rows = documents(docs, key, text).toDF("key", "text")
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # rows of one key, and equal rows too, may go to several shards
    rows = rows.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.col("key").asc_nulls_first(), "hash", "row"]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("key", "text")
    schema = to_arrow_schema(FORMAT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        encode, shard = encoder(WordEncoder, path), TaskContext.get().partitionId()
        tail = np.array([end], encode.width).tobytes()
        segment, local, keys, parts, size, end_of, since = 0, 0, [], [], 0, (), 0

        def close() -> pa.RecordBatch:
            nonlocal end_of, since
            present = np.array([k is not None for k in keys], np.uint8)
            plain = np.array([0 if k is None else k for k in keys], "<i8")
            since = since if end_of == (plain[0], present[0]) else 0
            nth, seed = _occurrences(plain, present, since), 0
            while len(np.unique(h := hashes(plain, present, nth, seed))) < len(h):
                seed += 1
            pilots, where = build(h)
            counts = np.array([len(p) for p in parts], np.int64) // encode.width.itemsize
            slots = np.zeros(len(keys), SLOT)
            slots["print"][where], slots["doc"][where] = h & np.uint64(0xFFFFFFFF), np.arange(len(keys))
            slots["start"][where], slots["count"][where] = np.cumsum(counts) - counts, counts
            there = plain[present == 1]
            row = [(shard << 32) + segment, int(there[0]) if len(there) else None, int(there[-1]) if len(there) else None, local, encode.width.itemsize, len(keys), int(counts.sum())]
            row += [b"".join(parts), plain.tobytes(), present.tobytes(), since, seed, pilots.astype("<u4").tobytes(), slots.tobytes()]
            end_of, since = (plain[-1], present[-1]), int(nth[-1]) + 1
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            whole, ends = encode.encode_all(batch.column(1))
            for row, k in enumerate(batch.column(0).to_pylist()):
                keys.append(k)
                parts.append(whole[ends[row - 1] if row else 0 : ends[row]].tobytes() + tail)
                size += len(parts[-1])
                if len(keys) >= SEGMENT_DOCS or size >= SEGMENT_BYTES:
                    yield close()
                    segment, local, keys, parts, size = segment + 1, local + size // encode.width.itemsize, [], [], 0
        if keys:
            yield close()

    short_batches(docs.sparkSession)
    return written(rows.mapInArrow(run, FORMAT), "shards", options={"parquet.page.row.count.limit": 1})


def _starts(shards: DataFrame) -> dict[int, int]:
    """Ids before each shard; one number for each file."""
    out, before = {}, 0
    for row in shards.groupBy(F.shiftright("place", 32).alias("shard")).agg(F.sum("tokens").alias("n")).orderBy("shard").collect():
        out[row.shard], before = before, before + row.n
    return out


def _open(batch: pa.RecordBatch, k: int):
    get = {name: batch.column(n)[k].as_py() for n, name in enumerate(batch.schema.names)}
    keys, present = np.frombuffer(get["keys"], "<i8"), np.frombuffer(get["present"], np.uint8)
    return get, keys, present, np.frombuffer(get["pilots"], "<u4"), np.frombuffer(get["slots"], SLOT)


def _ids(get: dict, start: int, count: int) -> np.ndarray:
    width = get["width"]
    return np.frombuffer(get["payload"], f"<u{width}", count, start * width).astype("<u4")


RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_all(shards: DataFrame) -> DataFrame:
    """Every document of written shards, found through the index: doc_id, start, n_tokens, ids_crc32."""
    starts = shards.sparkSession.sparkContext.broadcast(_starts(shards))

    def run(batch: pa.RecordBatch) -> dict:
        out = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
        for k in range(batch.num_rows):
            get, keys, present, pilots, slots = _open(batch, k)
            found = find(pilots, slots, hashes(keys, present, _occurrences(keys, present, get["since"]), get["seed"]))
            if (found["doc"] != np.arange(len(keys))).any():
                raise ValueError("a stored key is not in its index")
            base = starts.value[get["place"] >> 32] + get["local"]
            for d in range(len(keys)):
                ids = _ids(get, int(found["start"][d]), int(found["count"][d]))
                out["doc_id"].append(int(keys[d]) if present[d] else None)
                out["start"].append(base + int(found["start"][d]))
                out["n_tokens"].append(len(ids))
                out["ids_crc32"].append(zlib.crc32(ids.tobytes()))
        return out

    return map_batches(shards.select(*OPENED), run, RESULT)


def lookup(shards: DataFrame, keys: list[int]) -> DataFrame:
    """(doc_id, ids) of the named keys, a list that the driver holds.

    The directory (first and last keys) names the segments that may hold one; of the rest nothing but
    these two columns is read, so that bytes follow the number of keys.
    """
    spark, wanted = shards.sparkSession, np.array(sorted({int(k) for k in keys}), np.int64)

    def near(batch: pa.RecordBatch) -> dict:
        first, last = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
        at = np.searchsorted(wanted, first)
        hit = (at < len(wanted)) & (wanted[np.minimum(at, len(wanted) - 1)] <= last)
        return {"place": batch.column(0).filter(pa.array(hit))}

    if not len(wanted):
        return spark.createDataFrame([], "doc_id long, ids array<long>")
    places = [r.place for r in map_batches(shards.where("first is not null").select("place", "first", "last"), near, "place long").collect()]
    inside, held = F.lit(False), "spark.sql.parquet.pushdown.inFilterThreshold"
    if places:
        spark.conf.set(held, str(max(len(places), int(spark.conf.get(held)))))  # the list goes to the reader whole
        inside = F.col("place").isin(places)

    def run(batch: pa.RecordBatch) -> dict | None:
        out = {"doc_id": [], "ids": []}
        for k in range(batch.num_rows):
            get, stored, present, pilots, slots = _open(batch, k)
            low, high = stored[present == 1][[0, -1]]
            left = wanted[np.searchsorted(wanted, low) : np.searchsorted(wanted, high, side="right")]
            nth = np.where(left == stored[0], get["since"] if present[0] else 0, 0)
            while len(left):
                found = find(pilots, slots, hashes(left, np.ones(len(left), np.uint8), nth, get["seed"]))
                hit = found["doc"] < len(stored)
                hit[hit] = (stored[found["doc"][hit]] == left[hit]) & (present[found["doc"][hit]] == 1)
                for key, record in zip(left[hit], found[hit], strict=True):
                    out["doc_id"].append(int(key))
                    out["ids"].append(_ids(get, int(record["start"]), int(record["count"])).tolist())
                left, nth = left[hit], nth[hit] + 1
        return out if out["doc_id"] else None

    return map_batches(shards.where(inside).select(*OPENED), run, "doc_id long, ids array<long>")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return read_all(write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))
