"""Personal data: regular expressions propose spans, checksums confirm, nearby words adjust scores.

Base kinds are email, ip, card and phone; they stay whatever their score. The scored kinds are
iban (mod 97), ssn and secret (a quoted hexadecimal token after its name); their score starts at
what the pattern and checksum are worth, gains or loses by the words around the span, and has to
reach MIN_SCORE. An iban is kept beside base spans that it overlaps (its digits may pass for a
card's); an ssn or secret is left out where it lies within a base span. Offsets are code points,
end exclusive.

A null or empty text has no spans. Repeated rows are judged alike. Time is linear in the length
of a text: no pattern can backtrack over a run of characters.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sarweave.session import text_batches

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
BASE = KINDS[:4]
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
SECRET = re.compile(r"(?<=[\"'])[0-9a-fA-F]{32,64}(?=[\"'])")
#: Score of a span by kind before its context is read, and the score it has to reach.
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.5, "secret": 0.5}
MIN_SCORE = 0.6
#: Characters before a span in which context words are sought, and after it.
CONTEXT = (48, 24)
# Words near a span that make its kind likelier, or less likely.
NEAR = {
    "email": ("mail", "contact", "e-mail"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "transfer"),
    "ssn": ("ssn", "social", "security"),
    "secret": ("token", "key", "secret", "password"),
}
AGAINST = ("version", "isbn", "example", "order", "serial", "checksum", "sha1", "sha256", "md5", "commit")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN without spaces has the right check digits."""
    rest = 0
    for c in iban[4:] + iban[:4]:
        n = int(c, 36)
        rest = (rest * (100 if n > 9 else 10) + n) % 97
    return rest == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) of the four base kinds, sorted."""
    out = [(a, 0, b) for a, b in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in m.groups())]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def score(text: str, start: int, end: int, kind: str) -> float:
    around = f"{text[max(0, start - CONTEXT[0]) : start]} {text[end : end + CONTEXT[1]]}".lower()
    near = any(re.search(rf"\b{w}", around) for w in NEAR[kind])
    against = any(re.search(rf"\b{w}\b", around) for w in AGAINST)
    return round(min(1.0, START[kind] + 0.3 * near - 0.3 * against), 2)


def find_pii(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind as listed in KINDS."""
    if not text:
        return []
    found = base_spans(text)
    begins, ends = [a for a, _, _ in found], list(accumulate((b for _, _, b in found), max))
    more = [(m.start(), 4, m.end()) for m in IBAN.finditer(text) if mod97(m[0].replace(" ", ""))]
    more += [(m.start(), 5, m.end()) for m in SSN.finditer(text)]
    if '"' in text or "'" in text:
        more += [(m.start(), 6, m.end()) for m in SECRET.finditer(text)]
    scored = [(a, k, b, score(text, a, b, KINDS[k])) for a, k, b in found]
    for a, k, b in more:
        # Of the base spans that begin no later, one holds this span if the one that reaches furthest does.
        before = bisect_right(begins, a)
        if (s := score(text, a, b, KINDS[k])) >= MIN_SCORE and (k == 4 or not before or ends[before - 1] < b):
            scored.append((a, k, b, s))
    return [(KINDS[k], a, b, s) for a, k, b, s in sorted(scored)]


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))


def scan_pii(docs: DataFrame) -> DataFrame:
    """doc_id and pii, an array of (kind, start, end, score)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e, "score": x} for k, s, e, x in find_pii(t.as_py())] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], names=["doc_id", "pii"])

    text_batches(docs.sparkSession)
    at = docs.select("doc_id", "text")
    return at.mapInArrow(scan, T.StructType([at.schema["doc_id"], T.StructField("pii", SPAN)]))


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
