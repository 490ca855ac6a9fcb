"""Byte-level BPE against the library, with long and unsplit texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encode():
    return tokens.ByteEncoder(PATH)


def runs():
    rng = random.Random(11)
    alphabets = ["ab", "aeinorst", "thein gr".replace(" ", "q"), "0123456789", "éèü", "=-_", "\n", "中文字"]
    for alphabet in alphabets:
        for n in (1, 2, 9, 40, 300, 2000):
            yield "".join(rng.choice(alphabet) for _ in range(n))


def test_a_join_is_the_encoding_of_the_whole(plain, encode):
    rng = random.Random(1)
    for run in runs():
        letters = "".join(t for t, _ in plain.pre_tokenizer.pre_tokenize_str(run))
        want = [t.id for t in plain.model.tokenize(letters)]
        for _ in range(8):
            at = rng.randrange(len(letters) + 1)
            sides = [np.array([t.id for t in plain.model.tokenize(x)] if x else [], encode.width) for x in (letters[:at], letters[at:])]
            assert bpe.join(encode, *sides).tolist() == want


@pytest.mark.parametrize("leaf", [1, 3, 16, 100])
def test_a_tree_of_leaves_is_the_encoding_of_the_whole(plain, encode, leaf):
    for run in runs():
        letters = "".join(t for t, _ in plain.pre_tokenizer.pre_tokenize_str(run))
        leaves = [np.array([t.id for t in plain.model.tokenize(letters[k : k + leaf])], encode.width) for k in range(0, len(letters), leaf)]
        assert bpe.tree(encode, leaves).tolist() == [t.id for t in plain.model.tokenize(letters)]


def long_texts():
    rng = random.Random(5)
    words = "the of and to in is was for on that with as by at from are".split()
    prose = " ".join(rng.choice(words) + ("\n" if rng.random() < 0.1 else "") for _ in range(400))
    run = "".join(rng.choice("etaoinshr") for _ in range(900))
    return [prose, run, prose + run + "." + run + " end", "<|endoftext|>" + run + "<|endoftext|>" + run, "\n" * 700, " " * 500 + "x", run + "  " + "1234567890" * 50 + "don't" * 60, "é" * 300 + " " + "中" * 300, "!?" * 400 + "\x85" * 200]


def test_long_texts_as_blocks(plain, encode, monkeypatch):
    monkeypatch.setattr(bpe, "LONG", 64)
    monkeypatch.setattr(bpe, "LEAF", 32)
    for text in long_texts():
        blocks = bpe.blocks_of(encode, text)
        ids = bpe.assemble(encode, [b[0] for b in blocks], [b[1] for b in blocks], [bpe.encode_block(encode, k, c) for k, _, c in blocks])
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text[:60]


def test_the_query_on_odd_and_long_rows(spark, plain, tmp_path):
    long = ["".join(random.Random(k).choice("abcdefgh") for _ in range(bpe.LONG + 5000)) for k in range(2)]
    rows = [(1, "Hello  world"), (2, None), (3, ""), (None, "x"), (1, "Hello  world"), (4, long[0]), (4, long[0]), (5, "word " * 20000 + long[1] + " end"), (None, long[1])]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as ids", "2 as row", "3 as key").write.parquet(f"{tmp_path}/documents.parquet")
    out = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op6_bpe(spark, str(tmp_path)).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for key, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids
        want.append((str(key), len(ids), sha(",".join(map(str, ids))), sha(plain.decode(ids, skip_special_tokens=False))))
    assert out == sorted(want)


def test_the_test_table_and_the_empty_one(spark, plain, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    for r in docs.collect():
        assert out[r.doc_id].ids == plain.encode(r.text, add_special_tokens=False).ids
        assert out[r.doc_id].text == r.text
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert bpe.op6_bpe(spark, str(tmp_path)).collect() == []
