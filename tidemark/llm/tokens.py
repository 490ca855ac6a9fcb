"""Exact tokenizer encodings of whole texts, faster than text by text.

Both encoders cut texts only where the tokenizer's own pre-tokenisation must cut, so that pieces can
be encoded apart, and remember the ids of short pieces. Batches are cut, looked up and put together
in arrays; pieces that are not remembered are encoded by the tokenizers library itself. The tables
live in the worker process, are bounded and survive from task to task.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from tidemark.llm.common import HELD, give_back


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printing Latin-1 bytes
    stand for themselves, the others for the letters from U+0100 on, in order."""
    out, shifted = [], 0
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            out.append(chr(byte))
        else:
            out.append(chr(256 + shifted))
            shifted += 1
    return out


#: Latin-1 characters, read as bytes, to their letters.
LETTERS = {byte: ord(letter) for byte, letter in enumerate(byte_letters())}

# a task has one core: threads of the library's own only hold memory
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_encoders: dict[tuple[str, str], object] = {}
HELD.append(_encoders)


def load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Pieces:
    """Ids of short pieces of text, kept in arrays and looked up a whole batch at a time.

    A piece of at most 16 bytes is its own key, two 64-bit words, so a lookup is exact. The table is
    open-addressed and doubles as it fills, up to ``MOST`` pieces; then it is emptied, which only costs
    time.
    """

    FIRST_BITS, MOST = 16, 1_300_000
    #: Masks that keep the first n bytes of a little-endian word.
    KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)

    def __init__(self, width: np.dtype):
        self.width = width
        self.clear()

    def clear(self) -> None:
        self.count = self.used = 0
        self._slots(self.FIRST_BITS)
        self.starts, self.sizes, self.pool = np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int32), np.zeros(1 << 14, self.width)

    def _slots(self, bits: int) -> None:
        self.bits, self.mask = bits, (1 << bits) - 1
        self.low, self.high, self.entry = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    @staticmethod
    def _room(held: np.ndarray, used: int, more: int) -> np.ndarray:
        """An array with room for more, a quarter longer than it must be."""
        if used + more <= len(held):
            return held
        out = np.zeros((used + more) * 5 // 4, held.dtype)
        out[:used] = held[:used]
        return out

    @classmethod
    def keys(cls, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both words of pieces of ``data``, which ends in 16 spare bytes; sizes are 1 to 16."""
        words = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
        low = words[at] & cls.KEEP[np.minimum(size, 8)]
        return low, np.where(size > 8, words[np.minimum(at + 8, len(words) - 1)] & cls.KEEP[np.maximum(size, 8) - 8], np.uint64(0))

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        x = (low ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Entries of keys; -1 where a key is not held."""
        slot = self._slot(low, high)
        out = self.entry[slot]
        left = np.flatnonzero((out >= 0) & ((self.low[slot] != low) | (self.high[slot] != high)))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            out[left] = self.entry[slot[left]]
            left = left[(out[left] >= 0) & ((self.low[slot[left]] != low[left]) | (self.high[slot[left]] != high[left]))]
        return out

    def _put(self, low: np.ndarray, high: np.ndarray, entry: np.ndarray) -> None:
        slot, left = self._slot(low, high), np.arange(len(low))
        while len(left):
            free = left[self.entry[slot[left]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.entry[slot[put]], self.low[slot[put]], self.high[slot[put]] = entry[put], low[put], high[put]
            waiting = np.ones(len(low), bool)
            waiting[put] = False
            left = left[waiting[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def add(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Hold distinct new keys with their ids."""
        n = len(low)
        bits = self.bits
        while (self.count + n) * 8 > 5 << bits:
            bits += 1
        if bits > self.bits:
            held = self.entry >= 0
            old = self.low[held], self.high[held], self.entry[held]
            self._slots(bits)
            self._put(*old)
        self.pool = self._room(self.pool, self.used, len(ids))
        self.starts, self.sizes = self._room(self.starts, self.count, n), self._room(self.sizes, self.count, n)
        self.pool[self.used : self.used + len(ids)] = ids
        new = np.arange(self.count, self.count + n)
        self.sizes[new], self.starts[new] = sizes, self.used + np.cumsum(sizes) - sizes
        self.used, self.count = self.used + len(ids), self.count + n
        self._put(low, high, new)


class _Encoder:
    """What both encoders share: batches as pieces of bytes."""

    #: Texts of more bytes are encoded by themselves.
    LARGE = 1 << 22

    def __init__(self, path: str):
        self.tokenizer = load(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = max(vocabulary.values())
        self._learn(vocabulary)
        self.width = np.dtype("<u2") if self.last < 1 << 16 else np.dtype("<u4")
        self.pieces = Pieces(self.width)
        self.bare = Tokenizer(self.tokenizer.model)  # the same model, not another one
        self.bare.pre_tokenizer = WhitespaceSplit()
        del vocabulary
        give_back()

    def _learn(self, vocabulary: dict[str, int]) -> None:
        """What an encoder needs of the vocabulary."""

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.width) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a batch, one after another, and where each text's ids end."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        alone = np.flatnonzero(self._alone(texts).to_numpy(zero_copy_only=False))
        if len(alone):
            mask = np.zeros(len(texts), bool)
            mask[alone] = True
            whole, ends = self._batch(pc.if_else(pa.array(mask), "", texts))
            own = self._plain(texts.take(pa.array(alone)).to_pylist())
            counts = np.diff(ends, prepend=0)
            parts, done = [], 0
            for at, ids in zip(alone, own, strict=True):
                parts += [whole[done : ends[at]], ids]
                done, counts[at] = ends[at], len(ids)
            return np.concatenate([*parts, whole[done:]]), np.cumsum(counts)
        return self._batch(texts)

    def _batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        n = len(texts)
        bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        data = np.zeros(bounds[-1] - bounds[0] + 16, np.uint8)
        if len(data) > 16:
            data[:-16] = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        at, size = self._cut(data, bounds)
        ids, ends = self._look_up(data, at, size)
        return ids, ends[np.searchsorted(at, bounds[1:])]

    def _look_up(self, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after another, and the running count of ids (from 0)."""
        table = self.pieces
        if table.count + len(at) > table.MOST:
            table.clear()
        short = size <= 16
        low, high = table.keys(data, at, np.where(short, size, 1))
        entry = table.find(low, high)
        new = np.flatnonzero((entry < 0) & short)
        if len(new):
            order = new[np.lexsort((high[new], low[new]))]
            first = np.r_[True, (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])]
            distinct = order[first]
            texts = [bytes(data[a : a + s]).decode() for a, s in zip(at[distinct].tolist(), size[distinct].tolist(), strict=True)]
            ids, sizes = self._fresh(texts)
            table.add(low[distinct], high[distinct], ids, sizes)
            entry[new] = table.find(low[new], high[new])
        counts, starts, pool = table.sizes[entry].astype(np.int64), table.starts[entry].astype(np.int64), table.pool
        long = np.flatnonzero(~short)
        if len(long):
            texts = [bytes(data[a : a + s]).decode() for a, s in zip(at[long].tolist(), size[long].tolist(), strict=True)]
            distinct = list(dict.fromkeys(texts))
            ids, sizes = self._fresh(distinct)
            place = {t: k for k, t in enumerate(distinct)}
            which = np.fromiter((place[t] for t in texts), np.int64, len(texts))
            counts[long], starts[long] = sizes[which], table.used + (np.cumsum(sizes) - sizes)[which]
            pool = np.concatenate([pool[: table.used], ids])
        ends = np.concatenate([[0], np.cumsum(counts)])
        return pool[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], counts)], ends

    def _fresh(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct pieces one after another, and each one's number of ids."""
        words, others = [], []
        for k, text in enumerate(texts):
            letters = self._letters(text)
            if letters is None:
                others.append(k)
            else:
                words.append((k, letters))
        sizes, parts = np.zeros(len(texts), np.int64), [None] * len(texts)
        if others:
            for k, ids in zip(others, self._plain([texts[k] for k in others]), strict=True):
                parts[k], sizes[k] = ids, len(ids)
        for start in range(0, len(words), 2000):
            some = words[start : start + 2000]
            found = self.bare.encode_batch_fast([" ".join(x for _, x in some)], add_special_tokens=False)[0]
            ids = np.array(found.ids, self.width)
            for (k, _), part in zip(some, np.split(ids, self._word_ends(ids, found, [x for _, x in some])[:-1]), strict=True):
                parts[k], sizes[k] = part, len(part)
        return np.concatenate([*parts, np.empty(0, self.width)]), sizes


class WordEncoder(_Encoder):
    """Ids of a tokenizer that lower-cases, drops white space and marks the ends of words.

    White space ends every pre-token and leaves no id, so space and line feed separate pieces. A
    single mark of ``MARKS`` at the end of a piece is a pre-token of its own if an ASCII letter
    stands before it. ASCII capitals are lowered first, but for texts that may hold an added token,
    which is matched as written.
    """

    MARKS = np.zeros(256, bool)
    MARKS[list(b".,!?;:|")] = True

    def _learn(self, vocabulary: dict[str, int]) -> None:
        self.ends = np.zeros(self.last + 1, bool)
        for token, at in vocabulary.items():
            self.ends[at] = token.endswith("</w>")

    def _alone(self, texts: pa.Array) -> pa.Array:
        return pc.or_(pc.match_substring_regex(texts, "<\\||\\x00"), pc.greater(pc.binary_length(texts), self.LARGE))

    def _cut(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        body = data[:-16]
        body[(body >= 65) & (body <= 90)] += 32
        apart = (body == 32) | (body == 10)
        edge = np.zeros(len(body) + 1, bool)
        edge[bounds] = True
        at = np.flatnonzero(~apart & (np.r_[True, apart[:-1]] | edge[:-1])) if len(body) else np.empty(0, np.int64)
        end = np.flatnonzero(~apart & (np.r_[apart[1:], True] | edge[1:])) + 1 if len(body) else np.empty(0, np.int64)
        size = end - at
        before = data[np.maximum(end - 2, 0)]
        split = (size > 1) & self.MARKS[data[end - 1]] & (before >= 97) & (before <= 122)
        place = np.arange(len(at)) + np.cumsum(split) - split
        starts, sizes = np.zeros(len(at) + split.sum(), np.int64), np.ones(len(at) + split.sum(), np.int64)
        starts[place], sizes[place] = at, size - split
        starts[place[split] + 1] = end[split] - 1
        return starts, sizes

    @staticmethod
    def _letters(text: str) -> str | None:
        """The one pre-token of a piece in byte letters, if it is one of Latin-1 letters."""
        if text.isascii():
            return text if text.isalpha() else None
        if not text.isalpha() or max(text) > "\xff":
            return None
        return text.lower().encode().decode("latin-1").translate(LETTERS)

    def _word_ends(self, ids: np.ndarray, found, words: list[str]) -> np.ndarray:
        return np.flatnonzero(self.ends[ids]) + 1


class ByteEncoder(_Encoder):
    """Ids of a byte-level tokenizer whose words take the space before them, and what ids decode to.

    No pre-token goes from a printing character to a white-space character, and of two white-space
    characters the second goes with what follows, so every space and line feed begins a piece.
    Texts with three such characters in a row, two at the end, or characters outside ``SAFE`` (about
    which versions of the character tables might differ) go to the library whole. ``CUT`` finds the
    places at which any text may be cut.
    """

    SAFE = "!-~\xa1-\xac\xae-\u0233"
    CUT = re.compile(f"(?<=[{SAFE}])(?= )")
    ODD = "[^ \\n!-~\\x{a1}-\\x{ac}\\x{ae}-\\x{233}]|[ \\n]{3}|[ \\n]{2}$|<\\|"

    def __init__(self, path: str):
        super().__init__(path)
        self.special = {t.content: at for at, t in self.tokenizer.get_added_tokens_decoder().items()}
        if any(c.isspace() for t in self.special for c in t):
            raise ValueError("an added token holds white space")
        self.space = chr(LETTERS[32])
        self.lengths = np.array([len(t) for t in self.token], np.int64)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.bytes = _table([t.encode() if t in self.special else bytes(byte_of[c] for c in t) for t in self.token])
        self.decimals = _table([b"%d," % at for at in range(len(self.token))])

    def _learn(self, vocabulary: dict[str, int]) -> None:
        self.token = [""] * (self.last + 1)
        for token, at in vocabulary.items():
            self.token[at] = token

    def _alone(self, texts: pa.Array) -> pa.Array:
        return pc.or_(pc.match_substring_regex(texts, self.ODD), pc.greater(pc.binary_length(texts), self.LARGE))

    def _cut(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        body = data[:-16]
        if not len(body):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        begins = (body == 32) | (body == 10)
        begins[bounds[bounds < len(body)]] = True
        at = np.flatnonzero(begins)
        end = np.append(at[1:], len(body))
        before = data[np.maximum(end - 2, 0)] | 32
        split = (end - at > 1) & WordEncoder.MARKS[data[end - 1]] & (before >= 97) & (before <= 122) & (data[np.maximum(end - 2, 0)] >= 65)
        place = np.arange(len(at)) + np.cumsum(split) - split
        starts, sizes = np.zeros(len(at) + split.sum(), np.int64), np.ones(len(at) + split.sum(), np.int64)
        starts[place], sizes[place] = at, end - at - split
        starts[place[split] + 1] = end[split] - 1
        return starts, sizes

    def _letters(self, text: str) -> str | None:
        """The one pre-token of a piece in byte letters, if it is a space or nothing, then Latin-1 letters."""
        word, space = (text[1:], self.space) if text[0] == " " else (text, "")
        if not word.isalpha() or max(word) > "\xff":
            return None
        return space + (word if word.isascii() else word.encode().decode("latin-1").translate(LETTERS))

    def _word_ends(self, ids: np.ndarray, found, words: list[str]) -> np.ndarray:
        return np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(w) for w in words])) + 1

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The decoded texts, in UTF-8; what is no UTF-8 becomes replacement characters."""
        out = _gathered(self.bytes, ids, ends)
        for k, text in enumerate(out):
            try:
                text.decode()
            except UnicodeDecodeError:
                out[k] = text.decode("utf-8", "replace").encode()
        return out

    def joined_all(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Decimal ids joined by commas."""
        return [x[:-1] for x in _gathered(self.decimals, ids, ends)]

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([len(ids)]))[0].decode()


def _table(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in strings], np.int64)
    return np.frombuffer(b"".join(strings), np.uint8), np.cumsum(sizes) - sizes, sizes


def _gathered(table: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """For each run of ids (by their ends) the concatenation of the table's strings."""
    data, starts, sizes = table
    counts = sizes[ids]
    stops = np.concatenate([[0], np.cumsum(counts)])
    whole = data[np.arange(stops[-1]) + np.repeat(starts[ids] - stops[:-1], counts)].tobytes()
    cuts = [0, *stops[ends].tolist()]
    return [whole[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def encoder(kind: type, path: str):
    """The worker's encoder of a kind and file; made once in a process."""
    at = (kind.__name__, path)
    if at not in _encoders:
        _encoders[at] = kind(path)
    return _encoders[at]
