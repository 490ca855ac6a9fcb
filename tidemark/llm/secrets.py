"""Secrets: fixed expressions, and a guess-cost search over values in credential context.

Base kinds (assign, access, hex) follow fixed expressions, leftmost and non-overlapping per kind;
what fails its length is dropped and not retried. The added kind ``guess`` covers values that
stand after a credential word and a ``:`` or ``=`` but are too short or too oddly written for the
base expression. Such a value is reported if guessing it is dear: dynamic programming finds the
segmentation of least cost into dictionary words, dates, repeats, keyboard walks, alphabet runs,
addresses, separators and brute-force spans, and the value counts if that cost reaches
``LEAST_LOG10``; nothing else decides, so a value may be all letters or all digits.

The dictionary is ``WORDS``, then the ranked words and word parts of the tokenizer ``VOCABULARY``
(English), and for tables the words of the whole corpus in any language, ranked by the number of
rows that hold them outside credential values: all that stand in ``LEAST_ROWS`` rows, or the most
frequent ``SENT`` at most (words as rare as the first beyond that bound are left out).

Defined cases: null and empty texts have no spans; a null key stays null; repeated rows are
treated one by one; other columns are never read; an empty table gives an empty result. Offsets
are code points, the end exclusive.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, map_batches, release, table, texts_of, written
from tidemark.llm.pii import how_many, joined

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "guess")
PLACE = {kind: n for n, kind in enumerate(KINDS)}

#: The base expressions. Letters of the words match in either case, ASCII only.
ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
#: Credential context of the added kind.
CREDENTIAL = re.compile(r"""(?ai:(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|credential))["']?[\x20\t]{0,3}(?::|=>|=)[\x20\t]{0,3}["']?([^\s"'<>]{6,})""")
#: Every expression with a credential word needs one of these in the lower-cased text.
HINTS = ("passw", "passp", "pwd", "secret", "token", "api", "credential")

#: Guesses (log10) from which a value counts as a secret.
LEAST_LOG10 = 8.0

#: Common parts of chosen passwords, the likeliest first.
WORDS = (
    "password", "qwerty", "dragon", "monkey", "letmein", "login", "princess", "welcome", "admin", "master",
    "hello", "freedom", "whatever", "shadow", "sunshine", "football", "baseball", "superman", "batman", "trustno",
    "iloveyou", "love", "secret", "summer", "winter", "spring", "autumn", "pass", "user", "root",
    "test", "guest", "changeme", "default", "example", "token", "key", "api", "private", "public",
    "server", "database", "system", "secure", "access", "money", "star", "tiger", "angel", "flower",
)
#: Ranked words and word parts, the most frequent first.
VOCABULARY = "word_bpe_49k.json"
END_OF_WORD = "</w>"


#: Words of the corpus: the least number of rows, and the most words sent to the executors.
LEAST_ROWS, SENT = 4, 1 << 16
RUN = re.compile(r"[^\W\d_]{2,40}")


@cache
def ranks() -> tuple[dict[str, int], int]:
    """The dictionary: rank of each word, and the length of the longest."""
    import public_tokenizers

    with open(public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        ids = json.load(file)["model"]["vocab"]
    out = {word: n + 1 for n, word in enumerate(WORDS)}
    for entry in sorted(ids, key=ids.get):
        word = entry.removesuffix(END_OF_WORD)
        if word.isascii() and word.isalpha() and len(word) >= (2 if entry.endswith(END_OF_WORD) else 3):
            out.setdefault(word.lower(), len(out) + 1)
    return out, max(map(len, out))


LEET = str.maketrans("013457$@", "oieastsa")
#: Rows of a keyboard, left to right.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
NEXT = {(row[i], row[i + 1]) for row in ROWS for i in range(len(row) - 1)}
NEXT |= {(b, a) for a, b in NEXT}
#: An address up to its path, unless a user stands before the host; and signs between words.
ADDRESS = re.compile(r"(?ai:https?|ftps?|wss?)://[\w-]+(?:\.[\w-]+)*(?::[0-9]+)?(?![\w.:-])(?![^\s/?#]*@)")
SEPARATOR = re.compile(r"[-_./,:;!?)\]}]+")
DATE = re.compile(r"(?:19|20)[0-9]{2}(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12][0-9]|3[01]))?)?|(?:0[1-9]|[12][0-9]|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)[0-9]{2}")


def _alphabet(value: str) -> float:
    size = 10 * any(c.isdigit() for c in value) + 26 * any(c.islower() for c in value) + 26 * any(c.isupper() for c in value) + 33 * any(not c.isalnum() for c in value)
    return math.log10(max(size, 10))


def segments(value: str, known: tuple[dict[str, int], int] | None = None):
    """Cheap spans of a value: (start, end, log10 cost, kind)."""
    low = value.lower()
    plain = low.translate(LEET) if len(low.translate(LEET)) == len(value) else low
    n = len(value)
    words, longest = known or ranks()
    if len(low) != n:  # a character whose lower case is longer
        low = plain = value
    for i in range(n):
        for j in range(i + 2, min(n, i + longest) + 1):
            for form, extra in ((low, 0.0), (plain, 0.3)):
                if (rank := words.get(form[i:j])) is not None:
                    cased = 0.0 if value[i:j] == low[i:j] else 0.3 if value[i].isupper() and value[i + 1 : j] == low[i + 1 : j] else 1.0
                    yield i, j, math.log10(rank + 1) + extra + cased, "word"
                    break
    for m in ADDRESS.finditer(value):
        yield m.start(), m.end(), 2.0, "address"
    for m in SEPARATOR.finditer(value):
        yield m.start(), m.end(), 0.5 * len(set(m[0])), "separator"
    for m in DATE.finditer(value):
        yield m.start(), m.end(), 2.1 + 0.4 * max(0, m.end() - m.start() - 4), "date"
    for width in (1, 2, 3, 4):  # the same characters again and again
        i = 0
        while i + 2 * width <= n:
            j = i + width
            while j < n and value[j] == value[j - width]:
                j += 1
            if j - i >= max(3, 2 * width):
                yield i, j, width * _alphabet(value[i : i + width]) + math.log10((j - i) / width), "repeat"
                i = j - width + 1
            else:
                i += 1
    for kind, step in (("walk", lambda a, b: (a, b) in NEXT), ("run", lambda a, b: abs(ord(a) - ord(b)) == 1)):
        i = 0
        while i < n - 1:
            j = i + 1
            while j < n and step(low[j - 1], low[j]):
                j += 1
            if j - i >= 3:
                yield i, j, 1.6 + math.log10(j - i), kind
                i = j
            else:
                i += 1


def guess_cost(value: str, known: tuple[dict[str, int], int] | None = None) -> tuple[float, list[tuple[int, int, str]]]:
    """log10 of the guesses for a value, and its cheapest segmentation."""
    n, each = len(value), _alphabet(value)
    ending: dict[int, list] = {}
    for start, end, cost, kind in segments(value, known):
        ending.setdefault(end, []).append((start, cost, kind))
    best, back = [0.0] * (n + 1), [(0, "")] * (n + 1)
    for end in range(1, n + 1):
        best[end], back[end] = best[end - 1] + each, (end - 1, "brute")
        for start, cost, kind in ending.get(end, ()):
            if best[start] + cost < best[end]:
                best[end], back[end] = best[start] + cost, (start, kind)
    cut, at = [], n
    while at:
        start, kind = back[at]
        if kind == "brute" and cut and cut[-1][2] == "brute":
            cut[-1] = (start, cut[-1][1], kind)
        else:
            cut.append((start, at, kind))
        at = start
    return best[n], cut[::-1]


def spans_of(text: str, known: tuple[dict[str, int], int] | None = None) -> list[dict]:
    """All spans of a text, by start, then kind as listed. ``at`` is where the secret value begins."""
    out = []

    def put(kind: str, start: int, end: int, at: int, cost: float | None) -> None:
        out.append({"kind": kind, "start": start, "end": end, "at": at, "cost": None if cost is None else round(cost, 3)})

    low = text.lower()
    if any(hint in low for hint in HINTS):
        taken = []
        for m in ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= LEAST_ASSIGN:
                put("assign", m.start(), m.end(), m.start(1), guess_cost(m[1], known)[0])
                taken.append((m.start(1), m.end(1)))
        for m in CREDENTIAL.finditer(text):
            value = m[1]
            if not any(m.start(1) < e and s < m.end(1) for s, e in taken):
                if (cost := guess_cost(value, known)[0]) >= LEAST_LOG10:
                    put("guess", m.start(1), m.end(1), m.start(1), cost)
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                put("access", m.start(), m.end(), m.start(), None)
    for m in HEX.finditer(text):
        put("hex", m.start(), m.end(), m.start(), None)
    return sorted(out, key=lambda s: (s["start"], PLACE[s["kind"]]))


def prose_words(text: str) -> set[str]:
    """The lower-cased words of a text outside credential values."""
    low = text.lower()
    if any(hint in low for hint in HINTS):
        for expression in (ASSIGN, CREDENTIAL):
            text = expression.sub(" ", text)
        low = text.lower()
    return set(RUN.findall(low))


def corpus_ranks(docs: DataFrame, text: str = "text") -> tuple[dict[str, int], int]:
    """The dictionary with the words of all rows: at most ``SENT`` more."""

    def count(batch: pa.RecordBatch) -> dict | None:
        seen = Counter()
        for value in texts_of(batch.column(0)):
            seen.update(prose_words(value))
        return {"word": list(seen), "n": list(seen.values())} if seen else None

    counts = map_batches(documents(docs, text), count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = written(counts.where(F.col("n") >= LEAST_ROWS), "words", slim=True)
    least, total = None, 0
    for n, words in sorted(((r.n, r.words) for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True):
        total += words
        if total > SENT:
            break
        least = n
    found = [] if least is None else counts.where(F.col("n") >= least).collect()  # at most SENT
    release(counts)
    out = dict(ranks()[0])
    for rank, r in enumerate(sorted(found, key=lambda r: (-r.n, r.word))):
        out[r.word] = min(out.get(r.word, rank + 1), rank + 1)
    return out, max(map(len, out))


SPANS = "array<struct<kind:string,start:int,end:int,at:int,cost:double>>"


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key`` and ``spans``, an array of (kind, start, end, at, cost)."""
    rows = documents(docs, key, text)
    kind = rows.schema[key].dataType.simpleString()
    known = docs.sparkSession.sparkContext.broadcast(corpus_ranks(docs, text))

    def run(batch: pa.RecordBatch) -> dict:
        return {key: batch.column(0), "spans": [spans_of(x, known.value) for x in texts_of(batch.column(1))]}

    return map_batches(rows, run, f"`{key}` {kind}, spans {SPANS}")


#: What stands in place of a secret's value.
MASK = "[SECRET]"


def masked(text: str, known: tuple[dict[str, int], int] | None = None) -> str:
    """The text with every secret value replaced; the credential word before it stays."""
    parts, done = [], 0
    for start, end in sorted((s["at"], s["end"]) for s in spans_of(text, known)):
        if start >= done:
            parts += [text[done:start], MASK]
        done = max(done, end)
    return "".join([*parts, text[done:]]) if parts else text


def mask_secrets(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """All rows and columns; secret values in ``text`` are masked and ``length`` counts anew.

    A null text stays null, and a row without secrets is returned as it is.
    """
    schema = docs.schema
    where = schema.fieldNames().index(text)
    known = docs.sparkSession.sparkContext.broadcast(corpus_ranks(docs, text))
    count = schema.fieldNames().index(length) if length in schema.fieldNames() else None

    def run(batch: pa.RecordBatch) -> dict:
        out = {name: batch.column(n) for n, name in enumerate(schema.fieldNames())}
        before = batch.column(where).to_pylist()
        after = [x if x is None else masked(x, known.value) for x in before]
        out[text] = after
        if count is not None:
            out[length] = [n if a == b else len(b) for n, a, b in zip(batch.column(count).to_pylist(), before, after, strict=True)]
        return out

    return map_batches(docs, run, schema)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    count = [how_many(spans, kind).alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *count, F.sha2(joined(spans, BASE), 256).alias("base_sha256"), joined(spans).alias("spans"), F.array_max(F.transform(spans, lambda s: s["cost"])).alias("top_cost"))
