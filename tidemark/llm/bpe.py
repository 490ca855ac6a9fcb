"""Byte-level BPE encoding and decoding, with tree concatenation of long unsplit text.

A text is cut where pre-tokenisation must cut (see ``tokens``). Texts up to ``LONG`` characters are
encoded where they stand. Longer ones are cut into blocks that are encoded in parallel, as rows of
their own, and joined per document. A stretch without any place to cut (a run of letters, digits
or white space beyond ``LONG``) has to be one sequence of ids although no task should encode it
alone, so its pre-tokens are cut blindly into leaves, and their encodings are joined as a tree:

    join(left, right): encode again the window of the last k ids of left and the first k of right,
    k = 4, 8, 16, ... The join is exact as soon as the window's new ids begin with the window's
    first old id and end with its last old id, or the window reaches the end of a side.

That is enough, because a sequence of tokens is the encoding of its bytes exactly if every two
neighbours are what their own concatenation encodes to: inside the sides the neighbours are old
ones, inside the window they are new ones, and at the window's edges both sides agree on the token.

Defined cases: null and empty texts have no ids and decode to the empty text. Repeated rows and
rows with a null key are encoded one by one. Other columns are never read; an empty table gives an
empty result. Added tokens in a text are recognised as the library does by default.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, map_batches, table, texts_of, written
from tidemark.llm.tokens import ByteEncoder, encoder

#: Characters from which a text is cut into blocks, of a block, and bytes of a leaf.
LONG, LEAF = 1 << 15, 1 << 12
WINDOW = 4


def join(encode: ByteEncoder, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The encoding of the concatenation of two encoded stretches of one pre-token."""
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    k = WINDOW
    while True:
        a, b = min(k, len(left)), min(k, len(right))
        window = "".join(encode.token[i] for i in [*left[len(left) - a :], *right[:b]])
        ids = np.array([t.id for t in encode.tokenizer.model.tokenize(window)], encode.width)
        if (a == len(left) or ids[0] == left[len(left) - a]) and (b == len(right) or ids[-1] == right[b - 1]):
            return np.concatenate([left[: len(left) - a], ids, right[b:]])
        k *= 2


def tree(encode: ByteEncoder, leaves: list[np.ndarray]) -> np.ndarray:
    """Join neighbours, then neighbours of the joined, until one is left."""
    while len(leaves) > 1:
        leaves = [join(encode, *leaves[k : k + 2]) if k + 1 < len(leaves) else leaves[k] for k in range(0, len(leaves), 2)]
    return leaves[0]


def blocks_of(encode: ByteEncoder, text: str) -> list[tuple[str, int, str]]:
    """(kind, run, content) of the blocks of a long text, in order.

    ``text``: a stretch between two cuts; ``words``: whole pre-tokens in byte letters, parted by
    spaces; ``leaf``: a part of the pre-token numbered ``run``; ``added``: the id of an added token.
    """
    out, held, size, run = [], [], 0, 0

    def flush(kind: str, glue: str) -> None:
        nonlocal held, size
        if held:
            out.append((kind, -1, glue.join(held)))
        held, size = [], 0

    added = re.compile("|".join(f"({re.escape(t)})" for t in encode.special)) if encode.special else None
    for part in encode.CUT.split(text):
        if len(part) <= LONG:
            held.append(part)
            size += len(part)
            if size >= LONG:
                flush("text", "")
            continue
        flush("text", "")
        for piece in [x for x in added.split(part) if x] if added else [part]:
            if piece in encode.special:
                flush("words", " ")
                out.append(("added", -1, str(encode.special[piece])))
                continue
            for letters, _ in encode.tokenizer.pre_tokenizer.pre_tokenize_str(piece):
                if len(letters) <= LEAF:
                    held.append(letters)
                    size += len(letters)
                    if size >= LONG:
                        flush("words", " ")
                    continue
                flush("words", " ")
                out += [("leaf", run, letters[at : at + LEAF]) for at in range(0, len(letters), LEAF)]
                run += 1
        flush("words", " ")
    flush("text", "")
    return out


def encode_block(encode: ByteEncoder, kind: str, content: str) -> np.ndarray:
    if kind == "text":
        return encode.ids(content)
    if kind == "added":
        return np.array([int(content)], encode.width)
    return np.array([t.id for word in content.split(" ") for t in encode.tokenizer.model.tokenize(word)], encode.width)


def assemble(encode: ByteEncoder, kinds: list[str], runs: list[int], parts: list[np.ndarray]) -> np.ndarray:
    """The ids of a document from its encoded blocks, leaves joined by trees."""
    out, leaves = [], []
    for k, (kind, run, ids) in enumerate(zip(kinds, runs, parts, strict=True)):
        if kind == "leaf":
            leaves.append(ids)
            if k + 1 == len(kinds) or runs[k + 1] != run:
                out.append(tree(encode, leaves))
                leaves = []
        else:
            out.append(ids)
    return np.concatenate(out) if out else np.empty(0, encode.width)


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32)))


def _runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column one after another, and where each list's values end; null is empty."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)


def ids_column(e: ByteEncoder, ids: np.ndarray, ends: np.ndarray) -> dict:
    """What :func:`encode` gives of the ids of a batch: the ids themselves."""
    return {"ids": _lists(ids, ends)}


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", columns: str = "ids array<int>", give=ids_column) -> DataFrame:
    """Per row: ``key`` and ``ids``, the tokenizer's ids of the whole text.

    ``give`` may make other ``columns`` of the ids where they are, lest they travel.
    """
    rows = documents(docs, key, text).toDF("key", "text")
    kind = rows.schema["key"].dataType.simpleString()
    size = F.length(F.coalesce("text", F.lit("")))

    def direct(batch: pa.RecordBatch) -> dict:
        e = encoder(ByteEncoder, path)
        return {"key": batch.column(0)} | give(e, *e.encode_all(batch.column(1)))

    short = map_batches(rows.where(size <= LONG), direct, f"key {kind}, {columns}", keep=True)
    # the written table fixes the numbers of rows, which tell repeated rows apart
    long = written(rows.where(size > LONG).withColumn("row", F.monotonically_increasing_id()), "long")

    def cut(batch: pa.RecordBatch) -> dict:
        e = encoder(ByteEncoder, path)
        out = {"row": [], "block": [], "kind": [], "run": [], "content": []}
        for row, value in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
            for block, (what, run, content) in enumerate(blocks_of(e, value)):
                for c, x in zip(out, (row, block, what, run, content), strict=True):
                    out[c].append(x)
        return out

    def part(batch: pa.RecordBatch) -> dict:
        e = encoder(ByteEncoder, path)
        ids = [encode_block(e, what, content).tobytes() for what, content in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True)]
        return {c: batch.column(k) for k, c in enumerate(["row", "block", "kind", "run"])} | {"ids": ids}

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        e = encoder(ByteEncoder, path)
        group = group.sort_values("block")
        ids = assemble(e, group["kind"].tolist(), group["run"].tolist(), [np.frombuffer(x, e.width) for x in group["ids"]])
        out = give(e, ids.astype(np.int32), np.array([len(ids)]))
        return pd.DataFrame({"row": [group["row"].iloc[0]]} | {c: x.to_pylist() if isinstance(x, pa.Array) else x for c, x in out.items()})

    blocks = map_batches(long.select("row", "text"), cut, "row long, block int, kind string, run int, content string", keep=True)
    parts = map_batches(blocks.repartition("row", "block"), part, "row long, block int, kind string, run int, ids binary", keep=True)
    done = parts.groupBy("row").applyInPandas(whole, f"row long, {columns}")
    joined = long.select("key", "row").join(done, "row").drop("row")
    return short.unionByName(joined).withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: ``key``, ``ids`` and the text they decode to."""
    rows = documents(encoded, key, ids)
    kind = rows.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        e = encoder(ByteEncoder, path)
        return {key: batch.column(0), ids: batch.column(1), "text": [t.decode() for t in e.decode_all(*_runs(batch.column(1)))]}

    return map_batches(rows, run, f"`{key}` {kind}, `{ids}` array<int>, text string", keep=True)


def digests(e: ByteEncoder, ids: np.ndarray, ends: np.ndarray) -> dict:
    """Numbers of ids, and SHA-256 of the ids in decimals and of the texts they decode to."""
    sha = lambda texts: [hashlib.sha256(t).hexdigest() for t in texts]
    return {"n_tokens": np.diff(ends, prepend=0).tolist(), "ids_sha256": sha(e.joined_all(ids, ends)), "decoded_sha256": sha(e.decode_all(ids, ends))}


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encode(table(spark, sf_dir, "documents"), path, columns=columns, give=digests)
