"""Secret scans through a trigram inverted index.

For each rule's regular expression a Boolean query over trigrams is derived that every text with a
match must fulfil: strings that must occur one after the other are joined by AND, branches by OR.
A block of documents gets an inverted index of the trigrams that any query names, posting lists are
intersected and united, and only the candidates that remain are searched with the expression.
Rules whose query says nothing (a run of hexadecimal digits has no fixed trigram) search every text.

The index is built over ASCII-lower-cased UTF-8, so that it holds for rules in either case; it may
name too many candidates but never too few.  Blocks live inside one task and are bounded in rows;
nothing is shuffled.  Null text is empty and has no spans; repeated rows are scanned each.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellarium.llm.common import batches

BLOCK_ROWS = 512
MOST_STRINGS = 64  # alternatives that a query is spelled out for
MOST_LENGTH = 16


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 0  # characters of the group
    any_case: bool = False

    def regex(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The first three are given; the others are the published shapes of tokens.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 8, True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("repository", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    # User and password are of any length; of a longer scheme the last 21 characters are in the span.
    Rule("login", r"[A-Za-z][A-Za-z0-9+.-]{0,20}://[^\s/:@]+:[^\s/:@]+@"),
)
BASE = ("assign", "access", "hex")


# A query is True (says nothing), a trigram, or ("and" | "or", queries).
def _all(parts: list) -> object:
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts: list) -> object:
    parts = list(dict.fromkeys(parts))
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _spelled(strings: set[str]) -> object:
    def one(s: str) -> object:
        raw = s.lower().encode()
        return _all([raw[k : k + 3] for k in range(len(raw) - 2)])

    return _any([one(s) for s in sorted(strings)])


def _analyse(nodes) -> tuple[set[str] | None, object]:
    """All strings that the nodes match if these are few, else what a match must contain."""
    queries, now, whole = [], {""}, True
    for what, value in nodes:
        strings, inner = _node(what, value)
        joined = {a + b for a in now for b in strings} if strings is not None else None
        if joined and len(joined) <= MOST_STRINGS and max(map(len, joined)) <= MOST_LENGTH:
            now = joined
            continue
        queries += [_spelled(now), True if strings is not None else inner]
        now, whole = strings if strings is not None else {""}, False
    return (now, True) if whole else (None, _all([*queries, _spelled(now)]))


def _node(what, value) -> tuple[set[str] | None, object]:
    if what is op.LITERAL:
        return {chr(value)}, True
    if what is op.IN and all(k is op.LITERAL for k, _ in value) and len(value) <= 8:
        return {chr(v) for _, v in value}, True
    if what is op.SUBPATTERN:
        return _analyse(value[-1])
    if what is op.BRANCH:
        found = [_analyse(branch) for branch in value[1]]
        if all(s is not None for s, _ in found):
            strings = set().union(*[s for s, _ in found])
            if len(strings) <= MOST_STRINGS:
                return strings, True
        return None, _any([_spelled(s) if s is not None else q for s, q in found])
    if what in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, inner = value
        strings, query = _analyse(inner)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, True
        if low == 0:
            return None, True
        return None, _spelled(strings) if strings is not None else query
    return None, True


def trigram_query(pattern: str) -> object:
    strings, query = _analyse(parser.parse(pattern))
    return _spelled(strings) if strings is not None else query


def trigrams(query: object) -> set[bytes]:
    if query is True:
        return set()
    if isinstance(query, bytes):
        return {query}
    return set().union(*[trigrams(q) for q in query[1]])


def _code(trigram: bytes) -> int:
    return int.from_bytes(trigram, "big")


class Index:
    """Posting lists of the wanted trigrams over a block of texts."""

    def __init__(self, texts: list[bytes], wanted: np.ndarray):
        joined = b"\0\0\0".join(texts) + b"\0\0\0"
        raw = np.frombuffer(joined, np.uint8).astype(np.uint32)
        codes = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
        at = np.flatnonzero(wanted[codes])
        ends = np.cumsum([len(t) + 3 for t in texts])
        owner = np.searchsorted(ends, at, side="right")
        pairs = np.unique(codes[at].astype(np.int64) * len(texts) + owner)
        keys, docs = pairs // len(texts), pairs % len(texts)
        cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else []
        self.lists = dict(zip(keys[cuts].tolist(), np.split(docs, cuts[1:]), strict=True)) if len(keys) else {}
        self.every = np.arange(len(texts))
        self.none = np.zeros(0, np.int64)

    def answer(self, query: object) -> np.ndarray:
        if query is True:
            return self.every
        if isinstance(query, bytes):
            return self.lists.get(_code(query), self.none)
        found = [self.answer(q) for q in query[1]]
        join = np.intersect1d if query[0] == "and" else np.union1d
        return functools.reduce(join, found)


def scanner(rules: tuple[Rule, ...]):
    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = [(r, r.regex(), trigram_query(r.pattern)) for r in rules]
        wanted = np.zeros(1 << 24, dtype=bool)
        for _, _, query in plans:
            for trigram in trigrams(query):
                wanted[_code(trigram)] = True
        kind = pa.struct([("kind", pa.string()), ("nth", pa.int32()), ("from", pa.int64()), ("to", pa.int64())])
        for batch in batches(rows, BLOCK_ROWS):
            texts = [x.as_py() or "" for x in batch.column(1)]
            index = Index([t.encode().lower() for t in texts], wanted)
            found: list[list[tuple]] = [[] for _ in texts]
            for nth, (rule, regex, query) in enumerate(plans):
                for doc in index.answer(query):
                    for m in regex.finditer(texts[doc]):
                        if len(m[rule.group]) >= rule.least:
                            found[doc].append((m.start(), nth, m.end(), rule.kind))
            spans = [
                [{"kind": k, "nth": nth, "from": a, "to": b} for a, nth, b, k in sorted(one)]
                for one in found
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.list_(kind))], names=["_id", "spans"]
            )

    return scan


def spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id") -> DataFrame:
    """``key`` and all spans of each document, by start, then in the order of the rules."""
    rows = docs.select(F.col(key).alias("_id"), F.col("text"))
    id_kind = rows.schema["_id"].dataType.simpleString()
    span = "array<struct<kind:string,nth:int,`from`:bigint,`to`:bigint>>"
    found = rows.mapInArrow(scanner(rules), f"_id {id_kind}, spans {span}")
    return found.withColumnRenamed("_id", key)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans as text."""

    def written(some) -> F.Column:
        return F.array_join(
            F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["from"], s["to"])), ","
        )

    def of(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        key,
        *[of(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
