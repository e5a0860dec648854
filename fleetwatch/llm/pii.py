"""Personal data in texts by anchor expansion.

One Aho-Corasick automaton finds anchors: at-signs, plus signs before a digit, dotted and spaced pairs of digits,
address schemes and identifier cues. A local parser for each kind of anchor then walks outwards from it to the exact
boundaries and validates what it has. Anchors come in text order and a parser never looks behind the end of its last
match, so its matches are the leftmost non-overlapping ones:

    email    [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip       four numbers of at most 255 with dots between
    card     12 to 19 digits with single spaces or hyphens between, passing Luhn's check
    phone    plus sign, then 9 to 15 digits with spaces, brackets, dots and hyphens between
    url      scheme and everything up to white space, quotes or angle brackets, without closing punctuation
    account  the value after a cue such as account, iban, token or password, with a sign of assignment between
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.llm.support import pieces

KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]
SCHEMES = ("http://", "https://", "ftp://", "www.", "mailto:")
CUES = ("account", "acct", "iban", "konto", "compte", "cuenta", "token", "api_key", "apikey", "secret", "password", "passport", "ssn")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_URL = re.compile(r"[^\s\"'<>]+")
_VALUE = re.compile(
    r"(?:[ _-]?(?:no|nr|number|id)\.?)?\s{0,3}[=:#]\s{0,3}[\"']?"
    r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])|[A-Za-z0-9][A-Za-z0-9_./+-]*)"
)


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    digits = sorted(_DIGITS)
    found.add_word("@", ("email", 1))
    for a in digits:
        found.add_word(f"+{a}", ("phone", 2))
        for b in digits:
            found.add_word(f"{a}.{b}", ("ip", 3))
            for between in ("", " ", "-"):
                word = f"{a}{between}{b}"
                found.add_word(word, ("card", len(word)))
    for kind, words in (("url", SCHEMES), ("account", CUES)):
        for word in words:
            for spelt in {word, word.upper(), word.capitalize()}:
                found.add_word(spelt, (kind, len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for at, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if at % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _email(text, at, done):
    begin = at
    while begin > done and text[begin - 1] in _LOCAL:
        begin -= 1
    found = _DOMAIN.match(text, at + 1) if begin < at else None
    return (begin, found.end(), True) if found else None


def _ip(text, at, done):
    begin = at
    while begin > done and text[begin - 1] in _DIGITS:
        begin -= 1
    found = _IP.match(text, begin)
    if not found:
        return None
    parts = [p.lstrip("0") for p in found[0].split(".")]
    return begin, found.end(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _card(text, at, done):
    found = _CARD.match(text, at)
    digits = _NOT_DIGIT.sub("", found[0])
    return at, found.end(), 12 <= len(digits) <= 19 and luhn(digits)


def _phone(text, at, done):
    found = _PHONE.match(text, at)
    return found and (at, found.end(), 9 <= len(_NOT_DIGIT.sub("", found[0])) <= 15)


def _url(text, at, done):
    if at and text[at - 1].isalnum():
        return None
    found = _URL.match(text, at)
    end = at + len(found[0].rstrip(".,;:!?)]}"))
    scheme = next(s for s in SCHEMES if found[0].lower().startswith(s))
    return (at, end, True) if end - at > len(scheme) else None


def _account(text, at, done, cue):
    if at and text[at - 1].isalnum():
        return None
    found = _VALUE.match(text, at + cue)
    if not found:
        return None
    begin, end = found.span(1)
    value = text[begin:end].rstrip("./+-")
    return begin, begin + len(value), len(value) >= 8 and not _DIGITS.isdisjoint(value)


_PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "url": _url}


def find_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(begin, end, kind) in code points, end exclusive, by begin and then kind as in KINDS."""
    if not text:
        return []
    done, out = dict.fromkeys(KINDS, 0), []
    for last, (kind, length) in _anchors().iter(text):
        at = last - length + 1
        if at < done[kind]:
            continue
        found = _account(text, at, done[kind], length) if kind == "account" else _PARSERS[kind](text, at, done[kind])
        if found:
            begin, end, valid = found
            done[kind] = end
            if valid:
                out.append((begin, end, kind))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def spell(spans) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for begin, end, kind in spans)


def redact(text: str | None, spans: list[tuple[int, int, str]] | None = None) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first names the whole."""
    if text is None:
        return None
    out, at, spans = [], 0, find_spans(text) if spans is None else spans
    merged: list[list] = []
    for begin, end, kind in spans:
        if merged and begin < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([begin, end, kind])
    for begin, end, kind in merged:
        out += [text[at:begin], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, spans (array of begin, end, kind) and the redacted text of every row.

    A null text has no spans and stays null; an empty one stays empty. Repeated rows give repeated rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = batch.column(1).to_pylist()
            found = [find_spans(t) for t in texts]
            rows = [[{"begin": b, "end": e, "kind": k} for b, e, k in s] for s in found]
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
            clean = [redact(t, s) for t, s in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind), pa.array(clean, pa.string())], names=["key", "spans", "redacted"])

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("body"))
    return narrow.mapInArrow(run, "key long, spans array<struct<begin:int, end:int, kind:string>>, redacted string")


def pii_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digests of scan: key, n_<kind> of every kind, base_sha256 of the spans of BASE, all spans spelt out."""
    counts = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [find_spans(t) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0)]
            columns += [pa.array([sum(s[2] == k for s in spans) for spans in found], pa.int64()) for k in KINDS]
            base = [spell(s for s in spans if s[2] in BASE) for spans in found]
            columns.append(pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()))
            columns.append(pa.array([spell(spans) for spans in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["key", *counts, "base_sha256", "spans"])

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("body"))
    return narrow.mapInArrow(run, f"key long, {', '.join(f'{c} long' for c in counts)}, base_sha256 string, spans string")


def redact_column(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """docs with the personal data of one column replaced; `length` names a column of its code points to bring up to date.

    All other columns, whatever their names, stay as they are; no row is added or lost.
    """
    at, schema = docs.columns.index(text), docs.schema
    size_at = docs.columns.index(length) if length else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            columns = list(batch.columns)
            old = columns[at].to_pylist()
            new = [redact(t) for t in old]
            columns[at] = pa.array(new, columns[at].type)
            if size_at is not None:
                sizes = columns[size_at].to_pylist()
                sizes = [s if a == b else len(b) for s, a, b in zip(sizes, old, new, strict=True)]
                columns[size_at] = pa.array(sizes, columns[size_at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)
