"""The exact prefix join of crowded regions against all pairs."""

import random

import numpy as np
import pytest

from cohortflow.llm import minhash_forest as M
from cohortflow.llm import prefix_join as P
from cohortflow.llm import sets as S
from cohortflow.llm.components import components


def template_sets(n, seed=3, size=120):
    """Sets around one template: most a little below 0.8 to all others, many with one partner
    at or just above it."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    out = []
    for _ in range(n // 2):
        one = base.copy()
        own = rng.choice(size, 22, replace=False)
        one[own] = rng.integers(0, 1 << 63, 22, dtype=np.uint64)
        two = one.copy()
        moved = rng.choice(size, rng.integers(10, 16), replace=False)
        two[moved] = rng.integers(0, 1 << 63, len(moved), dtype=np.uint64)
        out += [np.unique(one), np.unique(two)]
    return out


def grouped(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(x) for x in range(n)]


def all_pairs(sets, percent):
    size = np.array([len(s) for s in sets])
    shared = S.intersections(sets)
    a, b = np.nonzero(np.triu(100 * shared >= percent * (size[:, None] + size[None, :] - shared), 1))
    return list(zip(a.tolist(), b.tolist()))


@pytest.mark.parametrize("block", [8, 512])
def test_finds_every_link(spark, block):
    sets = template_sets(120)
    links = all_pairs(sets, 80)
    parts = grouped(len(sets), random.Random(1).sample(links, len(links) // 3))
    rows = [(i, parts[i], bytearray(s.tobytes())) for i, s in enumerate(sets)]
    crowd = spark.createDataFrame(rows, "node long, part long, set binary")
    found = [(r.a, r.b) for r in P.prefix_links(crowd, 80, block).collect()]
    assert set(map(tuple, map(sorted, found))) <= set(links)
    known = [(i, p) for i, p in enumerate(parts)]
    assert grouped(len(sets), known + found) == grouped(len(sets), links)


def test_crowded_region_loses_no_link(spark, monkeypatch):
    """All texts in one region far over the limit, most links at the threshold: none is missed."""
    sets = template_sets(400)
    sketch = spark.createDataFrame([(i, [7]) for i in range(len(sets))], "node long, keys array<long>")
    packed = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "node long, set binary")
    monkeypatch.setattr(M.forest_regions, "__defaults__", (24,))
    roots = {r.node: r.root for r in components(M.forest_links(sketch, lambda nodes: packed, 80), "a", "b").collect()}
    wanted = grouped(len(sets), all_pairs(sets, 80))
    assert sum(roots.get(i, i) != wanted[i] for i in range(len(sets))) == 0
