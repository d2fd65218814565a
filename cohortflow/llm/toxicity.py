"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, maps homoglyphs and digit substitutions to letters and
turns punctuation into spaces; the lexicon is folded the same way. Entries are
whole words or word beginnings. Their weights are log-odds of labelled
documents, learned from a bounded sample (`SAMPLE` labelled rows, by hash
order). A match inside an exception phrase (a term with its neighbour that
clean documents use) does not count. The sum of the weights, and the sum per
word, go through a logistic curve fitted on the same sample.

Every document is scored whole, in one pass without a shuffle, from its text
alone.

Defined results: null and empty texts score like a text without matches;
without usable labels the lexicon is empty and every score is 0; labels with a
null id or value are ignored and of several labels of one document the largest
counts; rows are scored one by one, so repeated ids and rows stay; extra
columns pass through and may have any name that does not start with `__tox_`;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import map_rows

#: Labelled rows that the lexicon is learned from, at most.
SAMPLE = 12_000
#: Least likelihood ratio (G^2) and labelled documents of an entry. Copies of one text count once.
EVIDENCE, SUPPORT = 30.0, 5
#: Least weight: 20 times likelier in a toxic document.
WEIGHT = 3.0
SHORTEST, LONGEST = 4, 8

# Characters that look like a Latin letter, by that letter.
HOMOGLYPHS = {
    "a": "аαɑ", "b": "ьβ", "c": "сϲ", "d": "ԁɗ", "e": "еєε", "g": "ɡց", "h": "һн", "i": "іıιїl|", "j": "јϳ",
    "k": "кκ", "m": "м", "n": "пη", "o": "оοσօ", "p": "рρ", "q": "ԛ", "r": "гɼ", "s": "ѕ", "t": "тτ", "u": "υս",
    "v": "ѵν", "w": "ԝшω", "x": "хχ", "y": "уγү", "z": "ʐ",
}
# Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
_FOLD = {ord(c): letter for letter, same in HOMOGLYPHS.items() for c in same}
_FOLD |= {ord(c): letter for c, letter in SUBSTITUTES.items()}
_FOLD |= {c: " " for c in range(128) if not chr(c).isalnum() and c not in _FOLD}
_FOLD |= {ord(c): None for c in "​‌‍⁠﻿­"}


def fold(text: str | None) -> str:
    """Folded words between single or repeated spaces, with one at either end."""
    return f" {(text or '').lower().translate(_FOLD)} "


@dataclass
class Lexicon:
    """Weights by folded pattern (" word " or " beginning"), exception phrases
    and the logistic curve (bias, sum, sum per word)."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] | None = None

    def matcher(self):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for phrase in self.exceptions:
            automaton.add_word(phrase, (len(phrase), None))
        for pattern, weight in self.weights.items():
            automaton.add_word(pattern, (len(pattern), weight))
        if len(automaton):
            automaton.make_automaton()
        return automaton


def matches(automaton, folded: str) -> Iterator[tuple[int, int, float]]:
    """(start, end, weight) of the lexicon's matches outside exception phrases."""
    if not len(automaton):
        return
    found = [(end + 1 - size, end + 1, weight) for end, (size, weight) in automaton.iter(folded)]
    spared = sorted((a, b) for a, b, weight in found if weight is None)
    starts, reach = [a for a, _ in spared], list(accumulate((b for _, b in spared), max))
    for a, b, weight in found:
        if weight is None:
            continue
        before = bisect_right(starts, a + 1)  # phrases that begin no later; the farthest of them
        if not before or reach[before - 1] < b - 1:
            yield a, b, weight


def features(automaton, text: str | None) -> tuple[float, int]:
    """Sum of the weights matched in the text, and its number of folded words."""
    folded = fold(text)
    return sum(weight for _, _, weight in matches(automaton, folded)), len(folded.split())


def _inputs(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    total = np.maximum(total, 0)
    return np.stack([np.ones(len(total)), np.log1p(total), np.log1p(1000 * total / (words + 1))], axis=1)


def fit_curve(total: np.ndarray, words: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    x, beta = _inputs(total, words), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        ridge = 0.01 * np.eye(3)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (label - p) - ridge @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(b) for b in beta)


def grams(folded: str) -> set[str]:
    """The document's words and word beginnings, as patterns."""
    out = set()
    for word in set(folded.split()):
        if len(word) > 1:
            out.add(f" {word} ")
        for size in range(SHORTEST, min(LONGEST, len(word)) + 1):
            out.add(f" {word[:size]}")
    return out


def _counted(of):
    """Counts of what `of` finds in each text, by label: (pattern, bad, good)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad, good = Counter(), Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                (bad if label else good).update(of(text))
            both = list(bad | good)
            columns = [pa.array(both, pa.string()), *(pa.array([n[g] for g in both], pa.int64()) for n in (bad, good))]
            yield pa.RecordBatch.from_arrays(columns, ["pattern", "bad", "good"])

    return run


def _phrases(lexicon: Lexicon):
    automaton = None

    def of(text: str | None) -> set[str]:
        nonlocal automaton
        automaton = automaton if automaton is not None else lexicon.matcher()
        folded, out = fold(text), set()
        found = list(matches(automaton, folded))
        spans = [m.span() for m in re.finditer(r"\S+", folded)] if found else []
        starts = [low for low, _ in spans]
        for a, b, _ in found:
            low, high = a + 1, folded.index(" ", b - 1)
            before, after = bisect_left(starts, low) - 1, bisect_left(starts, high)
            if before >= 0:
                out.add(f" {folded[slice(*spans[before])]} {folded[low:high]} ")
            if after < len(spans):
                out.add(f" {folded[low:high]} {folded[slice(*spans[after])]} ")
        return out

    return of


def _telling(counts: DataFrame, bad: int, good: int) -> DataFrame:
    """Adds the log-odds weight and the likelihood ratio G^2 of each pattern."""
    t, c = F.col("bad"), F.col("good")
    share, rest = (t + c) * bad / (bad + good), (t + c) * good / (bad + good)
    term = lambda n, e: F.when(n > 0, n * F.log(n / e)).otherwise(0.0)
    return counts.withColumn("evidence", 2 * (term(t, share) + term(c, rest))).withColumn(
        "weight", F.log((t + 0.5) / (bad + 1)) - F.log((c + 0.5) / (good + 1))
    )


def closed(rows: list[tuple[str, int, float]]) -> dict[str, float]:
    """Of nested patterns found in the same documents the longest, and none
    that a kept shorter one already covers. rows: (pattern, documents, weight)."""
    kept: dict[str, float] = {}
    covered: dict[str, int] = {}
    for pattern, n, weight in sorted(rows, key=lambda r: (-r[1], -len(r[0]), r[0])):
        starts = [pattern[:size] for size in range(2, len(pattern))]
        if any(s in kept for s in starts) or n <= 1.05 * covered.get(pattern, 0):
            continue
        kept[pattern] = weight
        for s in starts:
            covered[s] = max(covered.get(s, 0), n)
    return kept


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", usable: Column | None = None, sample: int = SAMPLE) -> Lexicon:
    """Lexicon, exceptions and curve from labelled rows for which `usable` (a
    column of `labels`) holds. Reads at most `sample` labelled documents."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.where(usable) if usable is not None else known
    known = known.groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")  # at most `sample` rows
    rows = rows.groupBy("text").agg(F.max("label").alias("label")).persist()
    try:
        totals = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        bad, good = totals.get(1, 0), totals.get(0, 0)
        if not bad or not good:
            return Lexicon()
        schema = "pattern string, bad long, good long"
        sums = [F.sum("bad").alias("bad"), F.sum("good").alias("good")]
        counts = rows.mapInArrow(_counted(lambda text: grams(fold(text))), schema).groupBy("pattern").agg(*sums)
        best = _telling(counts, bad, good).where((F.col("bad") >= SUPPORT) & (F.col("evidence") >= EVIDENCE) & (F.col("weight") >= WEIGHT))
        found = best.collect()  # as many as the sample's documents support
        lexicon = Lexicon(closed([(r.pattern, r.bad, r.weight) for r in found]))
        phrases = rows.mapInArrow(_counted(_phrases(lexicon)), schema).groupBy("pattern").agg(*sums)
        spared = phrases.where((F.col("good") >= SUPPORT) & (F.col("bad") * good < F.col("good") * bad))
        lexicon.exceptions = tuple(sorted(r.pattern for r in spared.collect()))
        sums = scored(rows, lexicon, "text", raw=True).select("label", "__tox_sum", "__tox_words").toPandas()
        lexicon.curve = fit_curve(*(sums[c].to_numpy(dtype=float) for c in ("__tox_sum", "__tox_words", "label")))
        return lexicon
    finally:
        rows.unpersist()


def _scored(lexicon: Lexicon, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.matcher()
        for batch in batches:
            pairs = [features(automaton, text.as_py()) for text in batch.column(text_at)]
            total, words = np.array([p[0] for p in pairs], dtype=float), np.array([p[1] for p in pairs], dtype=float)
            score = np.zeros(len(pairs))
            if lexicon.curve is not None and len(pairs):
                score = 1 / (1 + np.exp(-np.clip(_inputs(total, words) @ np.array(lexicon.curve), -30, 30)))
            more = [pa.array(total), pa.array(words.astype(np.int64)), pa.array(score)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "__tox_sum", "__tox_words", "__tox_score"])

    return run


def scored(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", raw: bool = False) -> DataFrame:
    """`docs` with __tox_score (0 to 1) and, if `raw`, __tox_sum and __tox_words."""
    schema = docs.select("*", F.lit(0.0).alias("__tox_sum"), F.lit(0).cast("long").alias("__tox_words"), F.lit(0.0).alias("__tox_score")).schema
    out = map_rows(docs, _scored(lexicon, docs.columns.index(text_col)), schema)
    return out if raw else out.drop("__tox_sum", "__tox_words")


def held_out(key: Column) -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the documents that score 0.5 or more."""
    lexicon = learn(docs, labels, id_col, text_col, usable=~held_out(F.col(id_col)))
    return scored(docs, lexicon, text_col).where("__tox_score < 0.5").select(*[F.col(f"`{c}`") for c in docs.columns])
