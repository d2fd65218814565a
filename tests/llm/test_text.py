"""Vectorised words and shingles against regular expressions, and components against a plain union-find."""

import random

import numpy as np
import pyarrow as pa
import pytest

from corpus_fixtures import alnum, awkward, prose, spaced
from cohortflow.llm import text as T
from cohortflow.llm.components import components


@pytest.mark.parametrize("keep,plain", [(T.SPACED, spaced), (T.ALNUM, alnum)])
@pytest.mark.parametrize("piece", [7, 64, T.PIECE])
def test_words_equal_the_regular_expression(monkeypatch, keep, plain, piece):
    monkeypatch.setattr(T, "PIECE", piece)
    texts = [row[1] for row in awkward()]
    data, offsets = T.text_bytes(pa.array(texts, pa.string()))
    starts, ends, hashes, first = T.words(data, offsets, keep)
    seen = {}
    for row, text in enumerate(texts):
        own = [T.FOLD[data[a:b]].tobytes().decode() for a, b in zip(starts[first[row] : first[row + 1]], ends[first[row] : first[row + 1]])]
        assert own == plain(text)
        for word, h in zip(own, hashes[first[row] : first[row + 1]].tolist()):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_sliced_columns_and_no_rows():
    column = pa.array(["a b", None, "c d e", "f"])
    assert [len(s) for s in T.text_shingles(column.slice(1, 3), 2)] == [0, 2, 1]
    assert list(T.text_shingles(column.slice(0, 0), 2)) == []


def test_shingles_equal_word_tuples():
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(0, 30)) for _ in range(60)]
    names = {}
    for text, items in zip(texts, T.text_shingles(pa.array(texts), 3)):
        w = spaced(text)
        plain = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} - {()}
        assert len(items) == len(plain)
        for other, found in names.items():
            assert len(np.intersect1d(items, found[1])) == len(plain & found[0]), other
        names[text] = plain, items


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(7, 7), (None, 3)]
    links += [(100, x) for x in range(101, 160)] + [(x, x + 1) for x in range(200, 260)]
    parent = {x: x for a, b in links for x in (a, b) if x is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    out = components(spark.createDataFrame(links, "a long, b long").repartition(5), "a", "b")
    assert {(r.node, r.root) for r in out.collect()} == {(x, find(x)) for x in parent if find(x) != x}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_few_links_are_contracted_without_rounds(spark, monkeypatch):
    from cohortflow.llm import components as C

    def fails(links):
        raise AssertionError("a round of shuffles for a few links")

    links = [(i, i + 1) for i in range(0, 60)] + [(100, 103), (103, 101)]
    table = spark.createDataFrame(links, "a long, b long").repartition(7)
    want = {i: 0 for i in range(1, 61)} | {103: 100, 101: 100}
    with monkeypatch.context() as patch:
        patch.setattr(C, "_large_star", fails)
        assert {r.node: r.root for r in C.components(table, "a", "b").collect()} == want
    for limit in (5, 40):  # more links than a task takes: rounds, and the same roots
        monkeypatch.setattr(C, "TASK_LINKS", limit)
        assert {r.node: r.root for r in C.components(table, "a", "b").collect()} == want
