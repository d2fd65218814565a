"""Secret scan through a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived
that every match must satisfy. Every slice of an Arrow batch is one segment
of the index: a pass over its bytes collects the postings (trigram -> rows) of
the rules' trigrams, a rule's query is answered by intersecting and uniting
postings, and only the rows it leaves are verified with the regular expression.
Rules without a mandatory trigram scan every row. The index folds A-Z, so it
serves rules that ignore case as well.

Texts are whole, rows are independent and nothing is shuffled.

Defined results: a null text is an empty one, without spans; repeated ids and
rows stay; extra columns pass through and may have any name but `__secrets`; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import FOLD, map_rows, sliced, text_bytes

#: Strings that a part of a pattern may stand for before it counts as unknown, and the largest class that is spelt out.
STRINGS, CLASS = 64, 8
SCANNED = 4 << 20


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of `pattern`, leftmost and without overlaps, of
    which those stay whose `group` has `least` characters."""

    kind: str
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 0

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = re.compile(self.pattern, self.flags | re.ASCII).finditer(text)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


#: The base rules, then those that the method adds.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"://[^\x00-\x20/:@]+:[^\x00-\x20/:@]+@"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("api", r"AIza[A-Za-z0-9_-]{35,}"),
)

#: A query is a conjunction of clauses; a clause is a set of alternatives; an alternative is a set of trigrams.
Query = list[frozenset[frozenset[bytes]]]


def _clause(strings: set[str]) -> Query:
    """What every text that holds one of the strings satisfies."""
    folded = {s.encode().translate(FOLD.tobytes()) for s in strings}
    if any(len(s) < 3 for s in folded):
        return []
    return [frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in folded)]


def _class(items) -> set[str] | None:
    chars: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            chars.add(chr(value))
        elif kind is op.RANGE and value[1] - value[0] < CLASS:
            chars.update(map(chr, range(value[0], value[1] + 1)))
        else:
            return None
    return chars if len(chars) <= CLASS else None


def _element(kind, value) -> tuple[set[str] | None, Query]:
    """(all strings the element may stand for, or None; clauses it implies)."""
    if kind is op.LITERAL:
        return {chr(value)}, []
    if kind is op.IN:
        return _class(value), []
    if kind is op.SUBPATTERN:
        return _sequence(value[3])
    if kind is op.BRANCH:
        parts = [_sequence(part) for part in value[1]]
        if all(strings is not None for strings, _ in parts):
            strings = set().union(*(s for s, _ in parts))
            return (strings, []) if len(strings) <= STRINGS else (None, _clause(strings))
        clauses = [q + (_clause(s) if s is not None else []) for s, q in parts]
        return None, [frozenset().union(*(q[0] for q in clauses))] if all(clauses) else []
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, body = value
        strings, clauses = _sequence(body)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, []
        if low == high == 1:
            return strings, clauses
        if not low:
            return None, []
        return None, clauses + (_clause(strings) if strings is not None else [])
    if kind is op.AT:
        return {""}, []
    return None, []


def _sequence(items) -> tuple[set[str] | None, Query]:
    clauses: Query = []
    strings: set[str] = {""}
    exact = True
    for kind, value in items:
        more, implied = _element(kind, value)
        clauses += implied
        if more is not None and len(strings) * len(more) <= STRINGS:
            strings = {a + b for a in strings for b in more}
            continue
        exact = False
        clauses += _clause(strings)
        strings = more if more is not None and len(more) <= STRINGS else {""}
    if exact:
        return strings, clauses
    return None, clauses + _clause(strings)


def trigram_query(rule: Rule) -> Query:
    """Clauses that every text with a match of the rule satisfies; none: scan fully."""
    strings, clauses = _sequence(parser.parse(rule.pattern, rule.flags))
    return clauses + (_clause(strings) if strings is not None else [])


class Index:
    """Postings of chosen trigrams over one segment's rows."""

    def __init__(self, trigrams: list[bytes]) -> None:
        self.codes = np.sort(np.array([int.from_bytes(t, "big") for t in trigrams], dtype=np.uint32))
        self.wanted = np.zeros(1 << 24, dtype=bool)
        self.wanted[self.codes] = True

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> dict[bytes, np.ndarray]:
        pairs = [np.zeros(0, np.int64)]
        rows = len(offsets) - 1
        for at in range(0, max(0, len(data) - 2), SCANNED):
            part = FOLD[data[at : at + SCANNED + 2]].astype(np.uint32)
            codes = (part[:-2] << np.uint32(16)) | (part[1:-1] << np.uint32(8)) | part[2:]
            hits = np.flatnonzero(self.wanted[codes])
            row = np.searchsorted(offsets, hits + at, "right") - 1
            inside = hits + at + 3 <= offsets[row + 1]
            pairs.append(np.unique(np.searchsorted(self.codes, codes[hits[inside]]) * rows + row[inside]))
        found = np.unique(np.concatenate(pairs))
        cuts = np.searchsorted(found, np.arange(len(self.codes) + 1) * rows)
        return {int(c).to_bytes(3, "big"): found[a:b] - i * rows for i, (c, a, b) in enumerate(zip(self.codes, cuts[:-1], cuts[1:]))}


def candidates(query: Query, postings: dict[bytes, np.ndarray], rows: int) -> np.ndarray:
    """Rows that satisfy the query."""
    left = np.arange(rows)
    for clause in query:
        either = np.zeros(0, np.int64)
        for alternative in clause:
            both = None
            for trigram in alternative:
                own = postings[trigram]
                both = own if both is None else np.intersect1d(both, own, assume_unique=True)
            either = np.union1d(either, both)
        left = np.intersect1d(left, either, assume_unique=True)
    return left


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def _scanned(rules: tuple[Rule, ...], text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigram_query(rule) for rule in rules]
        index = Index(sorted({t for query in queries for clause in query for alternative in clause for t in alternative}))
        for batch in sliced(batches, text_at):
            data, offsets = text_bytes(batch.column(text_at))
            postings = index.postings(data, offsets)
            spans: list[list[tuple[int, int, int]]] = [[] for _ in range(batch.num_rows)]
            for order, (rule, query) in enumerate(zip(rules, queries)):
                for row in candidates(query, postings, batch.num_rows).tolist():
                    text = batch.column(text_at)[row].as_py() or ""
                    spans[row] += [(a, order, b) for a, b in rule.spans(text)]
            out = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(own)] for own in spans]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(SPAN))], [*batch.schema.names, "__secrets"])

    return run


def scan(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = (*BASE, *ADDED)) -> DataFrame:
    """`docs` with __secrets: spans (kind, start, end) in code points, end
    exclusive, by start and then in the order of the rules."""
    schema = docs.select("*", F.array().cast("array<struct<kind:string,start:int,end:int>>").alias("__secrets")).schema
    return map_rows(docs, _scanned(rules, docs.columns.index(text_col)), schema)
