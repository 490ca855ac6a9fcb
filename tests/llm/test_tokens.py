"""Tokenizer encodings, token files and packing against the library and exact round trips."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, tokenbin, tokens

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
POOL = [*"aZé́İßΣς'’s. ,!\n\t\x0b\x1c\x85\xa0 　中ァ9٣²½_<|>\U0001f600‍\xad", "<|endoftext|>", "<|startoftext|>", "  ", "'s", "don't", "\n\n", "Ångström", "ﬁ", "ὈΔΥΣΣΕΎΣ", "K", "token", "ization"]


def odd_texts(n, seed=0, most=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(POOL) for _ in range(rng.randrange(most))) for _ in range(n)]


@pytest.mark.parametrize(("kind", "path"), [(tokens.WordEncoder, WORD), (tokens.ByteEncoder, BYTE)])
def test_ids_are_the_librarys(kind, path):
    encode, plain = kind(path), Tokenizer.from_file(path)
    for text in odd_texts(5000) + ["x" * 5000, " " * 3000, "\n \n" * 500, "ab" * 400 + "!" * 700]:
        want = plain.encode(text, add_special_tokens=False).ids
        assert encode.ids(text).tolist() == want, text
        if kind is tokens.ByteEncoder:
            assert encode.decode(want) == plain.decode(want, skip_special_tokens=False), text


def test_a_batch_has_the_ids_of_its_texts():
    import pyarrow as pa

    for encode in (tokens.WordEncoder(WORD), tokens.ByteEncoder(BYTE)):
        check_batches(pa, encode)


def check_batches(pa, encode):
    rows = [*odd_texts(500, seed=3), None, "", "\n", "a  b\n\nc ", *odd_texts(50, seed=4)]
    for column in (pa.array(rows), pa.array(rows).slice(7, 300), pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        ids, ends = encode.encode_all(column)
        texts, start = column.to_pylist(), 0
        assert len(ends) == len(texts) and (not len(ends) or ends[-1] == len(ids))
        for text, end in zip(texts, ends, strict=True):
            assert ids[start:end].tolist() == encode.ids(text or "").tolist()
            start = end


def documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows][:300] + [(10_000 + k, t) for k, t in enumerate(odd_texts(60))] + [(20_000, None), (20_001, ""), (-5, "below zero"), (20_002, "many words " * 9000)]


def plain_ids(rows, end):
    tokenizer = Tokenizer.from_file(WORD)
    return [(k, [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]) for k, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_hold_every_document_in_order(spark, monkeypatch):
    monkeypatch.setattr(tokenbin, "SEGMENT_DOCS", 50)
    rows = documents(spark)
    out = tokenbin.read_all(tokenbin.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), WORD)).collect()
    want, before = [], 0
    for key, ids in sorted(plain_ids(rows, tokenbin.END)):
        want.append((key, before, len(ids), crc(ids)))
        before += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out) == want


def test_files_with_repeated_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(tokenbin, "SEGMENT_DOCS", 3)
    rows = [(7, f"word {k}") for k in range(8)] + [(None, "a"), (None, None), (None, "b c"), (1, "x"), (9, "y"), (7, "word 1")]
    shards = tokenbin.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), WORD)
    out = tokenbin.read_all(shards).collect()
    assert Counter((r.doc_id, r.ids_crc32) for r in out) == Counter((k, crc(i)) for k, i in plain_ids(rows, tokenbin.END))
    spans = sorted((r.start, r.n_tokens) for r in out)
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
    empty = tokenbin.write_shards(spark.createDataFrame([], "doc_id long, text string"), WORD)
    assert tokenbin.read_all(empty).collect() == []


def test_lookup_finds_what_is_there_and_refuses_the_rest(spark):
    rows = documents(spark)[:100] + [(-5, "below zero")]
    shards = tokenbin.write_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), WORD)
    ids = dict(plain_ids(rows, tokenbin.END))
    some = [*list(ids)[::9], -5]
    got = {r.doc_id: r.ids for r in tokenbin.lookup(shards, [*some, -1, 999_999, 123_456_789]).collect()}
    assert got == {k: ids[k] for k in some}


@pytest.mark.parametrize("n", [1, 2, 3, 17, 500, 2048])
def test_hash_function_is_minimal_and_perfect(n):
    h = tokenbin.hashes(np.arange(n) * 3 - 7, np.ones(n, np.uint8), np.zeros(n, np.int64))
    pilots, where = tokenbin.build(h)
    assert sorted(where.tolist()) == list(range(n))
    slots = np.zeros(n, tokenbin.SLOT)
    slots["print"][where], slots["doc"][where] = h & np.uint64(0xFFFFFFFF), np.arange(n)
    assert tokenbin.find(pilots, slots, h)["doc"].tolist() == list(range(n))
    other = tokenbin.hashes(np.arange(n) + 10**9, np.ones(n, np.uint8), np.zeros(n, np.int64))
    assert (tokenbin.find(pilots, slots, other)["doc"] == 0xFFFFFFFF).all()


def check_packing(spark, rows, length=packing.LENGTH):
    out = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), WORD, length=length).collect()
    want, got = defaultdict(list), defaultdict(list)
    for key, ids in plain_ids(rows, packing.END):
        want[key].append((ids, len(ids)))
    for r in out:
        got[r.doc_id].append(r)
    assert set(want) == set(got)
    for key, [(ids, n)] in ((k, v) for k, v in want.items() if len(v) == 1):
        pieces = sorted(got[key], key=lambda r: r.start)
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1].tolist()]
        assert sum(r.length for r in pieces) == n == pieces[0].doc_tokens
        assert all(crc(ids[r.start : r.start + r.length]) == r.ids_crc32 for r in pieces)
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for spans in sequences.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
        assert sum(spans[-1]) <= length
    return len(sequences), sum(r.length for r in out)


def test_packing_places_every_id_once(spark):
    sequences, ids = check_packing(spark, documents(spark))
    assert ids > 0.97 * packing.LENGTH * sequences


def test_packing_of_edge_cases(spark):
    assert check_packing(spark, [(1, None), (2, ""), (None, "a"), (None, "b"), (4, "a b"), (4, "a b")], length=4)[0] <= 4
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), WORD).collect() == []


def test_patterns_hold_the_histogram():
    rng = random.Random(4)
    for length in (8, 64, 2048):
        for _ in range(30):
            histogram = {rng.randrange(1, length + 1): rng.randrange(1, 500) for _ in range(rng.randrange(1, 40))}
            patterns = packing.pack(histogram, length)
            held = Counter()
            for pattern, n in patterns:
                assert sum(s * t for s, t in pattern) <= length
                for s, t in pattern:
                    held[s] += t * n
            assert held == Counter(histogram)
    assert sum(n for _, n in packing.pack({1: 10_000}, 2048)) == 5


def test_lookup_finds_all_documents_of_a_repeated_key(spark, monkeypatch):
    monkeypatch.setattr(tokenbin, "SEGMENT_DOCS", 4)
    rows = [(7, f"word {k}") for k in range(30)] + [(7, "same")] * 9 + [(0, "zero")] * 6 + [(None, "none")] * 7 + [(k, f"other {k}") for k in range(8, 40)]
    shards = tokenbin.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), WORD)
    got = Counter((r.doc_id, crc(r.ids)) for r in tokenbin.lookup(shards, [7, 0, 12, -3]).collect())
    assert got == Counter((k, crc(i)) for k, i in plain_ids(rows, tokenbin.END) if k in (7, 0, 12))
    assert Counter(r.doc_id for r in tokenbin.read_all(shards).collect()) == Counter(k for k, _ in rows)
    assert tokenbin.lookup(shards, []).collect() == []
    every = [r for r in tokenbin.lookup(shards, list(range(10_000))).collect()]
    assert len(every) == len(rows) - 7


def test_equal_rows_go_to_several_shards(spark):
    docs = spark.createDataFrame([(1, "same text")] * 4000, "doc_id long, text string").repartition(4)
    shards = tokenbin.write_shards(docs, WORD)
    assert max(r.n for r in shards.groupBy((shards.place / (1 << 32)).cast("long").alias("shard")).agg({"docs": "sum"}).toDF("shard", "n").collect()) < 2500
    assert tokenbin.read_all(shards).count() == 4000 == tokenbin.lookup(shards, [1]).count()


def test_every_seed_is_another_function():
    h = [tokenbin.hashes(np.arange(50), np.ones(50), np.zeros(50), seed) for seed in range(4)]
    assert len(np.unique(np.concatenate(h))) == 200
    assert all(sorted(tokenbin.build(x)[1].tolist()) == list(range(50)) for x in h)


def test_extra_columns_with_names_of_ours(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "x", 2, 3), (2, None, 6, "y", 3, 4)], "doc_id long, text string, key int, hash string, part int, place int")
    assert tokenbin.read_all(tokenbin.write_shards(docs, WORD)).count() == 2 == packing.pack_documents(docs, WORD).count()
