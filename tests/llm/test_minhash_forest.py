"""LSH forest near-duplicates against all pairs."""

import random

import pytest

from corpus_fixtures import awkward, frame, prose, spaced
from cohortflow.llm import minhash_forest as M
from cohortflow.llm import sets as S


def brute(rows, size, percent):
    """{doc_id: smallest reachable doc_id}"""
    sets = []
    for doc, text, *_ in rows:
        w = spaced(text)
        sets.append((doc, {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}))
    parent = {doc: doc for doc, _ in sets if doc is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is None or b is None or not x or not y:
                continue
            if 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {doc: find(doc) for doc in parent}, sets


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_equal_to_all_pairs(spark, size, percent):
    rows = awkward()
    roots, sets = brute(rows, size, percent)
    out = M.near_duplicates(frame(spark, rows), words=size, percent=percent).collect()
    assert len(out) == len(rows)
    assert sorted((r.doc_id, r.n_shingles) for r in out if r.doc_id is not None) == sorted((d, len(s)) for d, s in sets if d is not None)
    for r in out:
        assert r.component_id == roots.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == roots[r.doc_id])


def variants(n, seed=5, words=60):
    """One text and n copies with one or two words changed each: similarities around the threshold."""
    rng = random.Random(seed)
    base = prose(rng, words).split()
    rows = [(0, " ".join(base), "en", "s")]
    for i in range(1, n):
        own = list(base)
        for _ in range(rng.randint(1, 2)):
            own[rng.randrange(len(own))] = f"w{i}"
        rows.append((i, " ".join(own), "en", "s"))
    return rows


def test_crowded_regions_are_divided(spark, monkeypatch):
    """Regions far over the limit: deeper levels and blocks still find the whole group."""
    rows = variants(150)
    roots, _ = brute(rows, 3, 85)
    monkeypatch.setattr(M.forest_regions, "__defaults__", (24,))
    out = {r.doc_id: r.component_id for r in M.near_duplicates(frame(spark, rows), words=3, percent=85).collect()}
    wrong = sum(out[d] != roots[d] for d in roots)
    assert wrong <= 1  # a link is found with high probability, not with certainty


def test_spanning_links_of_a_region(spark):
    rows = variants(40, words=30)
    roots, sets = brute(rows, 3, 85)
    names = {t: i for i, t in enumerate(sorted({t for _, s in sets for t in s}))}
    import numpy as np

    packed = [np.array(sorted(names[t] for t in s), dtype=np.uint64) for _, s in sets]
    links = list(S.region_links([d for d, _ in sets], packed, 85))
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        assert a != b  # a forest
        parent[b] = a
    assert {d: find(d) for d in parent} == roots


def test_deduplicated_keeps_one_of_each(spark):
    rows = awkward()
    docs = frame(spark, rows)
    roots, _ = brute(rows, 5, 80)
    out = M.deduplicated(docs)
    assert out.columns == docs.columns
    found = [r.doc_id for r in out.collect()]
    assert sorted(d for d in found if d is not None) == sorted(set(roots.values()))
    assert found.count(None) == sum(r[0] is None for r in rows)


def test_empty_table(spark):
    docs = frame(spark, [])
    assert M.near_duplicates(docs).count() == 0
    assert M.deduplicated(docs).count() == 0
