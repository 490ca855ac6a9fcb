"""Personal data: expressions propose spans, checksums confirm them, nearby words adjust a score.

Base kinds (email, ip, card, phone) follow fixed expressions, leftmost and non-overlapping per
kind; what fails its check is dropped and not retried. Two kinds are added by the method: ``iban``
(confirmed by the mod-97 checksum) and ``ssn`` (kept only if a context word stands close by). An
account number may be followed by capitals: its country's length, or for a country without a known
one every length that is allowed, the longest first, has to pass the checksum. Every span carries a
score in 0..1: a prior for its kind, raised by whole context words within ``LOOK`` characters on
either side, the nearer the more. Scores decide about added kinds only, so base spans never depend
on context.

Scans are linear in the text: an email is found from its ``@`` outwards and an address from its
whole dotted run, which gives the leftmost matches without trying every start in a long word.

Defined cases: null and empty texts have no spans; a null key stays null; repeated rows are
treated one by one; other columns are never read; an empty table gives an empty result. Offsets
are code points, the end exclusive.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, map_batches, table, texts_of

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")
KINDS = BASE + ADDED

#: Characters of an address's local part, and the expressions of each kind.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: Characters of an account number by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29,
    "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29,
    "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

#: Words that make a kind likelier when they stand near the span.
CONTEXT = {
    "email": ("mail", "contact", "write", "address", "reach"),
    "ip": ("ip", "host", "server", "address", "login", "client"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "payment", "cvv"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "whatsapp"),
    "iban": ("iban", "account", "bank", "konto", "transfer", "bic", "swift"),
    "ssn": ("ssn", "social", "security", "taxpayer", "tin"),
}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
#: What a context word adds right beside a span; half of it at a distance of LOOK characters.
BONUS, LOOK = 0.3, 96
#: Least score of an added span.
LEAST = 0.45
_WORDS = {kind: re.compile(rf"(?<![A-Za-z])(?:{'|'.join(words)})s?(?![A-Za-z])", re.IGNORECASE) for kind, words in CONTEXT.items()}

SPANS = "array<struct<kind:string,start:int,end:int,value:string,score:double>>"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    rest = 0
    for char in moved:
        for digit in str(int(char, 36)):
            rest = (rest * 10 + ord(digit) - 48) % 97
    return rest == 1


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and (not part or int(part) <= 255)


def emails(text: str) -> list[tuple[int, int]]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            done = domain.end()
            found.append((start, done))
        at = text.find("@", max(at + 1, done))
    return found


def addresses(text: str) -> list[tuple[int, int]]:
    found = []
    for run in DOTTED.finditer(text):
        if run.end() - run.start() < 7:
            continue
        parts, at = run[0].split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(map(_small, four)):
                found.append((at, end))
            at = end + 1
    return found


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = match[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(match.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15] if "+" in text else []


def ibans(text: str) -> list[tuple[int, int]]:
    found, at = [], 0
    while match := IBAN.search(text, at):
        run, known = match[0], IBAN_LENGTHS.get(match[0][:2])
        at = match.start() + 2
        ends = [k + 1 for k, char in enumerate(run) if char != " "]  # where each of its characters ends
        for size in (known,) if known else range(min(len(ends), 34), 14, -1):
            if size > len(ends):
                continue
            end = match.start() + ends[size - 1]
            if not text[end : end + 1].isalnum() and mod97(run[: ends[size - 1]].replace(" ", "")):
                found.append((match.start(), end))
                at = end
                break
    return found


def ssns(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in SSN.finditer(text) if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000"] if "-" in text else []


FINDERS = {"email": emails, "ip": addresses, "card": cards, "phone": phones, "iban": ibans, "ssn": ssns}


def score(kind: str, text: str, start: int, end: int) -> float:
    """The kind's prior, raised by the nearest of its words; one cut off by the window's edge is none."""
    near = LOOK + 1
    for lo, hi in ((max(0, start - LOOK), start), (end, min(len(text), end + LOOK))):
        for word in _WORDS[kind].finditer(text, lo, hi):
            if not (word.end() == hi < len(text) and text[hi].isalpha()):
                near = min(near, start - word.end() if hi == start else word.start() - end)
    bonus = BONUS * (1 - 0.5 * near / LOOK) if near <= LOOK else 0.0
    return round(min(1.0, PRIOR[kind] + bonus), 3)


def spans_of(text: str) -> list[dict]:
    """All spans of a text, by kind as listed, then start."""
    out = []
    for kind in KINDS:
        for start, end in FINDERS[kind](text):
            value = score(kind, text, start, end)
            if kind in BASE or value >= LEAST:
                out.append({"kind": kind, "start": start, "end": end, "value": text[start:end], "score": value})
    return out


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key`` and ``spans``, an array of (kind, start, end, value, score)."""
    rows = documents(docs, key, text)
    kind = rows.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        return {key: batch.column(0), "spans": [spans_of(x) for x in texts_of(batch.column(1))]}

    return map_batches(rows, run, f"`{key}` {kind}, spans {SPANS}")


def joined(spans, kinds=None):
    """Spans as kind:start:end, comma-joined."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def how_many(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    count = [how_many(spans, kind).alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *count, F.sha2(joined(spans, BASE), 256).alias("base_sha256"), joined(spans).alias("spans"), F.array_max(F.transform(spans, lambda s: s["score"])).alias("top_score"))
