"""The claim language: parsing, canonical form and identity, in plain Python and as Arrow-batched column functions.

A document is a list of records, one statement each, with metadata lines (``# comment``, ``#@name payload``) before it:

    source://thing :: season=1,episode=1..3 @2 <=> [other://a,other://b]

Operators are ``<=>`` (exact), ``<~>`` (coverage) and ``=>`` (implication). A side is a selection (a reference with an optional
selector and extent) or an ordered composite in brackets. Identity is the hash of the canonical statement: predicates by name,
sets sorted as text, extents divided by their common divisor, sides of symmetric operators in byte order.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import pandas as pd
from pyspark.sql import functions as F

#: Tag hashed before a canonical statement; claims of another engine keep their ids by passing its tag.
CLAIM_TAG = b"catenary-claim:v1\0"
#: Fixed limits of the language.
MAX_DEPTH, MAX_EXTENT = 128, (1 << 64) - 1

_SYMMETRIC = ("<=>", "<~>")
_REFERENCE = re.compile(r"[A-Za-z][A-Za-z0-9._-]*://[^\x00-\x20,<>\[\]\x7f]+")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_-]*")
_BARE = re.compile(r"[A-Za-z0-9_:+%@-]+(?:\.[A-Za-z0-9_:+%@-]+)*")
_QUOTED = re.compile(r'"((?:[^"\\\x00-\x1f]|\\["\\nrt])*)"')
_NOT_BARE = re.compile(r"::|@[1-9][0-9]*")
_EXTENT = re.compile(r" +@([1-9][0-9]*)")
_OPERATOR = re.compile(r" +(<=>|<~>|=>) +")
_METADATA = re.compile(r"#(?: .*|@[A-Za-z_][A-Za-z0-9_-]* +.+)?")
_UNESCAPED = {'\\"': '"', "\\\\": "\\", "\\n": "\n", "\\r": "\r", "\\t": "\t"}
_ESCAPED = {v: k for k, v in _UNESCAPED.items()}


class ClaimError(ValueError):
    """A text that is no claim, or a claim that says nothing valid."""


@dataclass(frozen=True)
class Value:
    """kind: scalar (items has one), set (items), range (low, high, one of them open) or wildcard."""

    kind: str
    items: tuple[str, ...] = ()
    low: str | None = None
    high: str | None = None

    def canonical(self) -> str:
        if self.kind == "wildcard":
            return "*"
        if self.kind == "range":
            return f"{'' if self.low is None else scalar(self.low)}..{'' if self.high is None else scalar(self.high)}"
        if self.kind == "set":
            return "{" + ",".join(scalar(x) for x in sorted(set(self.items), key=str.encode)) + "}"
        return scalar(self.items[0])


@dataclass(frozen=True)
class Selection:
    reference: str
    predicates: tuple[tuple[str, Value], ...] = ()
    recursive: bool = False
    extent: int = 1

    @property
    def source(self) -> str:
        return self.reference.split("://", 1)[0]

    @property
    def key(self) -> str:
        """What is selected, without the extent."""
        if self.recursive:
            return f"{self.reference} :: **"
        if not self.predicates:
            return self.reference
        return f"{self.reference} :: " + ",".join(f"{n}={v.canonical()}" for n, v in sorted(self.predicates, key=lambda p: p[0].encode()))

    def canonical(self, divisor: int = 1) -> str:
        extent = self.extent // divisor
        return self.key if extent == 1 else f"{self.key} @{extent}"

    @property
    def dynamic(self) -> bool:
        return self.recursive or any(v.kind == "wildcard" or v.kind == "range" and None in (v.low, v.high) for _, v in self.predicates)


@dataclass(frozen=True)
class Composite:
    parts: tuple[Selection | Composite, ...]

    def canonical(self, divisor: int = 1) -> str:
        return "[" + ",".join(p.canonical(divisor) for p in self.parts) + "]"


def leaves(side: Selection | Composite, path: tuple[int, ...] = ()) -> Iterator[tuple[tuple[int, ...], Selection]]:
    """The selections of a side in order, with the path of child numbers that leads to each."""
    if isinstance(side, Selection):
        yield path, side
    else:
        for i, part in enumerate(side.parts):
            yield from leaves(part, (*path, i))


@dataclass(frozen=True)
class Statement:
    left: Selection | Composite
    operator: str
    right: Selection | Composite

    @property
    def divisor(self) -> int:
        return math.gcd(*(s.extent for side in (self.left, self.right) for _, s in leaves(side)))

    def sides(self) -> tuple[Selection | Composite, Selection | Composite]:
        """The sides in canonical order."""
        pair = (self.left, self.right)
        if self.operator in _SYMMETRIC:
            pair = tuple(sorted(pair, key=lambda s: s.canonical(self.divisor).encode()))
        return pair

    def canonical(self) -> str:
        left, right = (s.canonical(self.divisor) for s in self.sides())
        return f"{left} {self.operator} {right}"

    def claim_id(self, tag: bytes = CLAIM_TAG) -> str:
        return "v1:" + hashlib.sha256(tag + self.canonical().encode()).hexdigest()


@dataclass(frozen=True)
class Record:
    statement: Statement
    metadata: tuple[str, ...] = field(default=())

    def canonical(self) -> str:
        return "\n".join([*self.metadata, self.statement.canonical()]) + "\n"


def scalar(text: str) -> str:
    """A scalar as written: bare where that is read back as the same, else quoted."""
    if _BARE.fullmatch(text) and not _NOT_BARE.fullmatch(text):
        return text
    return '"' + "".join(_ESCAPED.get(c, c) for c in text) + '"'


class _Reader:
    """One line of text and a place in it."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def take(self, pattern: re.Pattern | str) -> re.Match | str | None:
        if isinstance(pattern, str):
            if self.text.startswith(pattern, self.at):
                self.at += len(pattern)
                return pattern
            return None
        found = pattern.match(self.text, self.at)
        if found:
            self.at = found.end()
        return found

    def need(self, pattern: re.Pattern | str, what: str) -> re.Match | str:
        found = self.take(pattern)
        if found is None:
            raise ClaimError(f"{what} expected at {self.at}")
        return found

    def scalar(self) -> str | None:
        if quoted := self.take(_QUOTED):
            return re.sub(r"\\.", lambda m: _UNESCAPED[m.group()], quoted[1])
        here = self.at
        bare = self.take(_BARE)
        if bare and (_NOT_BARE.fullmatch(bare.group()) or self.text.startswith("//", self.at)):
            self.at = here
            return None
        return bare.group() if bare else None

    def value(self) -> Value:
        if self.take("*"):
            return Value("wildcard")
        if self.take("{"):
            items = []
            while True:
                item = self.scalar()
                if item is None:
                    raise ClaimError(f"scalar expected at {self.at}")
                items.append(item)
                if not self.take(","):
                    break
            self.need("}", "end of set")
            return Value("set", tuple(sorted(set(items), key=str.encode)))
        low = self.scalar()
        if self.take(".."):
            high = self.scalar()
            if low is None and high is None:
                raise ClaimError("a range needs a bound")
            return Value("range", low=low, high=high)
        if low is None:
            raise ClaimError(f"value expected at {self.at}")
        return Value("scalar", (low,))

    def selection(self) -> Selection:
        reference = self.need(_REFERENCE, "reference").group()
        recursive, predicates = False, []
        if self.take(_SEPARATOR):
            if self.take("**"):
                recursive = True
            else:
                while True:
                    name = self.need(_NAME, "dimension").group()
                    self.need("=", "=")
                    if any(name == n for n, _ in predicates):
                        raise ClaimError(f"dimension {name} twice")
                    predicates.append((name, self.value()))
                    if not self.take(_NEXT_PREDICATE):
                        break  # another comma goes on with the composite around the selection
        extent = int(e[1]) if (e := self.take(_EXTENT)) else 1
        if extent > MAX_EXTENT:
            raise ClaimError("extent too large")
        return Selection(reference, tuple(predicates), recursive, extent)

    def side(self, depth: int = 1) -> Selection | Composite:
        if not self.take("["):
            return self.selection()
        if depth >= MAX_DEPTH:
            raise ClaimError("nested too deeply")
        parts = [self.side(depth + 1)]
        while self.take(","):
            parts.append(self.side(depth + 1))
        self.need("]", "end of composite")
        return Composite(tuple(parts))


_SEPARATOR = re.compile(r" +:: +")
_NEXT_PREDICATE = re.compile(r",(?![A-Za-z][A-Za-z0-9._-]*://)")


def parse_statement(text: str) -> Statement:
    reader = _Reader(text)
    left = reader.side()
    operator = reader.need(_OPERATOR, "operator")[1]
    right = reader.side()
    if reader.at != len(text):
        raise ClaimError(f"end expected at {reader.at}")
    return Statement(left, operator, right)


def parse(text: str) -> list[Record]:
    """The records of a document."""
    if not text:
        return []
    lines = re.split(r"\r?\n", text)
    if lines[-1] == "":
        lines.pop()
    records, metadata = [], []
    for line in lines:
        if line.startswith("#"):
            if not _METADATA.fullmatch(line) or "\r" in line:
                raise ClaimError("neither comment nor annotation")
            metadata.append(line)
        else:
            records.append(Record(parse_statement(line), tuple(metadata)))
            metadata = []
    if metadata:
        raise ClaimError("metadata without a statement")
    return records


def parse_record(text: str) -> Record:
    records = parse(text)
    if len(records) != 1:
        raise ClaimError("exactly one record expected")
    return records[0]


def decisions_document(decisions: list[tuple[Record, bool]]) -> tuple[str, str]:
    """The accepted and the rejected records as two documents in order of claim id; a claim may be decided once."""
    by_id = sorted((record.statement.claim_id(), record.canonical(), accepted) for record, accepted in decisions)
    if any(a[0] == b[0] for a, b in pairwise(by_id)):
        raise ClaimError("a claim is decided more than once")
    return tuple("".join(text for _, text, a in by_id if a is accepted) for accepted in (True, False))


PARSED = "struct<ok: boolean, error: string, canonical: string, claim_id: string, operator: string, selections: array<struct<side: int, path: array<int>, reference: string, key: string, extent: decimal(20,0), dynamic: boolean, recursive: boolean, predicates: array<struct<dimension: string, kind: string, items: array<string>, low: string, high: string>>>>>"


def _parsed_row(text: str | None, tag: bytes) -> dict:
    from decimal import Decimal

    try:
        statement = parse_record(text or "").statement
    except ClaimError as e:
        return {"ok": False, "error": str(e), "canonical": None, "claim_id": None, "operator": None, "selections": []}
    found = [
        {"side": side, "path": list(path), "reference": s.reference, "key": s.key, "extent": Decimal(s.extent // statement.divisor), "dynamic": s.dynamic, "recursive": s.recursive,
         "predicates": [{"dimension": n, "kind": v.kind, "items": list(v.items), "low": v.low, "high": v.high} for n, v in s.predicates]}
        for side, expression in enumerate(statement.sides())
        for path, s in leaves(expression)
    ]
    return {"ok": True, "error": None, "canonical": statement.canonical(), "claim_id": statement.claim_id(tag), "operator": statement.operator, "selections": found}


def parsed(tag: bytes = CLAIM_TAG):
    """A column function: one record's text to its canonical form, id and flattened selections, or the error."""

    @F.pandas_udf(PARSED)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [_parsed_row(t, tag) for t in texts]
        return pd.DataFrame(rows, columns=["ok", "error", "canonical", "claim_id", "operator", "selections"])

    return run


def bare_claim(left, right, operator: str = "<=>"):
    """The canonical statement of two bare references as a built-in expression."""
    if operator in _SYMMETRIC:
        left, right = F.least(left, right), F.greatest(left, right)
    return F.concat(left, F.lit(f" {operator} "), right)


def claim_id(canonical, tag: bytes = CLAIM_TAG):
    """The id of a canonical statement as a built-in expression."""
    return F.concat(F.lit("v1:"), F.sha2(F.concat(F.lit(tag), F.encode(canonical, "UTF-8")), 256))


def common_divisor(extents):
    """The greatest common divisor of an array of bigint, by Euclid as a built-in expression: 92 steps are enough for 64 bits."""
    step = lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), (s["a"] % F.nullif(s["b"], F.lit(0))).alias("b")))
    euclid = lambda g, x: F.aggregate(F.sequence(F.lit(1), F.lit(92)), F.struct(g.alias("a"), x.alias("b")), step, lambda s: s["a"])
    return F.aggregate(extents, F.lit(0).cast("bigint"), euclid)


def is_claim_id(c):
    return c.rlike("^v1:[0-9a-f]{64}$")


def is_reference(c):
    return c.rlike(r"^[A-Za-z][A-Za-z0-9._-]*://[^\x00-\x20,<>\[\]\x7F]+$")
