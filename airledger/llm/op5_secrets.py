"""Secret scans by assignment-aware lexing, beside fixed patterns.

Method: source and configuration text is lexed into name-literal pairs: a name, bare or
quoted, an optional type annotation, an assignment sign (``=``, ``:=``, ``:``, ``=>``) and a
value made of quoted or bare literals and earlier names joined by ``+``. Quoted literals may
hold escapes, and literals are as long as they are. Names bind constants in the order of the
text, so a literal given to a harmless name counts for the sensitive name it is later assigned
to. A pair's score comes from how sensitive the words of its target name are and from how much
the value looks like key material; the literals of pairs that score enough are spans of kind
``literal``. They add to the fixed patterns, which stay as they are.

A task reads one text at a time; nothing is shuffled. Joined values keep character counts and
links to their parts instead of text, so the work stays near the length of the text however
often constants are joined.

Odd rows: a null or empty text has no spans. Repeated rows are scanned one by one, an empty
table gives an empty result. Other columns pass through, whatever their names; those the query
adds (``n_assign`` and so on) are replaced.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airledger.llm.mapping import replaced_text, with_columns
from airledger.llm.tables import passing, read

KINDS = ("assign", "access", "hex", "literal")
MASK = "[REDACTED]"
LEAST_SCORE = 1.0
LEAST_VALUE = 0.3
_LOWER, _UPPER, _DIGITS = map(frozenset, (string.ascii_lowercase, string.ascii_uppercase, string.digits))
# The three patterns every scan has to report.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

_TARGET = re.compile(
    r"(?<![\w.-])([\"']?)([A-Za-z_][\w.-]*)\1[ \t]*"
    r"(?::[ \t]*(?P<kind>[A-Za-z_][\w.]*(?:\[[^\]\n]*\])?)[ \t]*=(?![=>])|(?::=|=>|[:=])(?![=>]))[ \t]*",
    re.ASCII,
)
_TERM = re.compile(
    r"\"((?:[^\"\\\n]|\\.)*+)\"|'((?:[^'\\\n]|\\.)*+)'|([^\s\"'`,;(){}\[\]<>+]++)"
)
_PLUS = re.compile(r"[ \t]*\+[ \t]*")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: How much a word in a target name says about its value.
_SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "token": 0.8,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "auth": 0.5,
    "private": 0.5, "access": 0.4, "api": 0.4, "signing": 0.5, "encryption": 0.5, "key": 0.5,
}


def name_score(name: str) -> float:
    """The sum over a name's words, split at signs and capitals; 0 for harmless names."""
    return sum(_SENSITIVE.get(w.lower(), 0.0) for w in _WORDS.findall(name))


class Value:
    """A literal, or several joined: how often it holds which character, and its places."""

    __slots__ = ("counts", "length", "span", "parts", "reported")

    def __init__(self, counts: Counter, length: int, span=None, parts=()) -> None:
        self.counts, self.length, self.span, self.parts = counts, length, span, parts
        self.reported = False

    def joined(self, other: Value) -> Value:
        return Value(self.counts + other.counts, self.length + other.length, None, (self, other))

    def score(self) -> float:
        """0 to 1 for length, variety and mixture of character classes; spaces speak against."""
        if self.length < 8:
            return 0.0
        shares = [n / self.length for n in self.counts.values()]
        entropy = -sum(p * math.log2(p) for p in shares)
        kinds = {
            "a" if c in _LOWER else "A" if c in _UPPER else "0" if c in _DIGITS else "#"
            for c in self.counts
        }
        spaced = max(0.0, 1 - 4 * self.counts[" "] / self.length)
        return min(1.0, entropy / 4) * (0.5 + 0.25 * min(len(kinds) - 1, 2)) * spaced

    def report(self, found: set[tuple[int, int]]) -> None:
        """Add the places of all parts, each part once in its life."""
        todo = [self]
        while todo:
            value = todo.pop()
            if not value.reported:
                value.reported = True
                todo.extend(value.parts)
                if value.span:
                    found.add(value.span)


def value_score(text: str) -> float:
    return Value(Counter(text), len(text)).score()


def lexed(text: str) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name, in order, without repeats."""
    if "=" not in text and ":" not in text:
        return []
    constants: dict[str, Value | tuple[int, int]] = {}
    found: set[tuple[int, int]] = set()

    def of(known: Value | tuple[int, int]) -> Value:
        if isinstance(known, Value):
            return known
        start, end = known
        return Value(Counter(text[start:end]), end - start, known)

    at = 0
    while target := _TARGET.search(text, at):
        # An annotation may be a name of its own, as in a: b=c.
        at = target.start("kind") if target["kind"] else target.end()
        value: Value | tuple[int, int] | None = None
        here = target.end()
        while term := _TERM.match(text, here):
            group = term.lastindex
            part: Value | tuple[int, int] = term.span(group)
            if group == 3:
                part = constants.get(term[group], part)
            # A single literal is looked at only if a sensitive name needs it.
            value = part if value is None else of(value).joined(of(part))
            # The next pair may begin inside a bare value, as in a=b=c.
            at = max(at, term.end()) if group < 3 and not target["kind"] else at
            plus = _PLUS.match(text, term.end())
            if not plus:
                break
            here = plus.end()
        if value is None:
            continue
        name = target[2]
        sensitive = name_score(name)
        if sensitive:
            value = of(value)
            score = value.score()
            if score >= LEAST_VALUE and sensitive + score >= LEAST_SCORE:
                value.report(found)
        constants[name] = value
    return sorted(span for span in found if span[0] < span[1])


def spans_of(text: str) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` in code points, by start, then kind in the order of ``KINDS``."""
    found = [(*m.span(), 0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(*m.span(), 1) for m in _ACCESS.finditer(text)]
    found += [(*m.span(), 2) for m in _HEX.finditer(text)]
    found += [(*span, 3) for span in lexed(text)]
    return [(start, KINDS[kind], end) for start, kind, end in sorted((s, k, e) for s, e, k in found)]


def redact(text: str, spans: list[tuple[int, str, int]]) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by a mask, ``n_chars`` following; other texts unchanged."""

    def work(text):
        spans = spans_of(text) if text else []
        return (redact(text, spans) if spans else text,)

    field = T.StructField("_redacted", T.StringType())
    return passing(docs, lambda d: replaced_text(d, with_columns(d, [field], work), "_redacted"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [
        *(T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]

    def work(text):
        spans = spans_of(text or "")
        counts = Counter(kind for _, kind, _ in spans)
        base = ",".join(f"{k}:{s}:{e}" for s, k, e in spans if k != "literal")
        return (
            *(counts[kind] for kind in KINDS),
            hashlib.sha256(base.encode()).hexdigest(),
            ",".join(f"{k}:{s}:{e}" for s, k, e in spans),
        )

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return with_columns(docs, fields, work).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"
    )
