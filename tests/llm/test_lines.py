"""Fuzzy line deduplication against all pairs of lines."""

import random

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpus_fixtures import awkward, frame, prose
from cohortflow.llm import lines as L
from cohortflow.llm import minhash_forest as M
from cohortflow.llm import sets as S
from cohortflow.llm.components import Forest
from cohortflow.llm.sets import intersections


def shingled(line):
    codes = line + "\0" * (L.CHARS - 1)
    return {codes[i : i + L.CHARS] for i in range(len(line))}


def brute(rows):
    """Component of every compared line, as its members."""
    own = sorted({s for _, text, *_ in rows if text for line in text.split("\n") if (s := line.strip(" ").lower())})
    sets = [shingled(s) for s in own]
    parent = list(range(len(own)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(own)):
        for j in range(i):
            if min(len(sets[i]), len(sets[j])) * 100 < 80 * max(len(sets[i]), len(sets[j])):
                continue
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {s: find(i) for i, s in enumerate(own)}


def test_equal_to_all_pairs(spark):
    rng = random.Random(4)
    rows = [r for r in awkward(n=10) if r[0] not in (206,)]
    base = prose(rng, 30).replace("\n", " ")
    near = [base[:at] + "X" + base[at + 1 :] for at in range(0, len(base), 9)]
    rows += [(700 + i, "\n".join([line, "", "  ", prose(rng, 4), base.upper() if i % 5 == 0 else "x", "License text"]), "en", "s") for i, line in enumerate(near)]
    group = brute(rows)
    out = L.near_duplicate_lines(frame(spark, rows)).collect()
    places = sorted(((r[0], i, line) for r in rows if r[1] for i, line in enumerate(r[1].split("\n"))), key=lambda p: (p[0] is not None, p[0] or 0, p[1]))
    assert len(out) == len(places)
    first = {}
    for doc, i, line in places:
        first.setdefault(group.get(line.strip(" ").lower()), (doc, i))
    lines = {}
    for doc, i, line in places:
        lines.setdefault((doc, i), set()).add(line.strip(" ").lower())
    names = {}
    for r in out:
        candidates = {group.get(s) for s in lines[r.doc_id, r.line_no]}
        if r.component is None:
            assert None in candidates and r.kept
        elif len(candidates) == 1:
            (own,) = candidates
            assert names.setdefault(r.component, own) == own
            assert (r.first_id, r.first_line) == first[own]
            assert r.kept == ((r.doc_id, r.line_no) == first[own])
    assert len(names) == len(set(names.values()))


def test_template_of_many_variants(spark):
    """1,200 lines of one template: each has one partner at 0.8 or a little more, all share the crowded buckets."""
    rng = random.Random(8)
    base = "".join(rng.choices("abcdefghij klmnopqrst", k=150)).strip().replace("  ", "xy")
    changed = lambda line, places: "".join(rng.choice("0123456789") if i in places else c for i, c in enumerate(line))
    lines = []
    for _ in range(600):
        one = changed(base, rng.sample(range(len(base)), 2))
        lines += [one, changed(one, rng.sample(range(len(base)), 2))]
    lines = sorted(set(lines))
    names: dict = {}
    sets = [np.array(sorted(names.setdefault(x, len(names)) for x in shingled(line)), dtype=np.uint64) for line in lines]
    size = np.array([len(s) for s in sets])
    shared = intersections(sets)
    forest = Forest()
    for a, b in zip(*np.nonzero(np.triu(100 * shared >= 80 * (size[:, None] + size[None, :] - shared), 1))):
        forest.union(int(a), int(b))
    out = L.near_duplicate_lines(frame(spark, [(i, line, "en", "s") for i, line in enumerate(lines)])).collect()
    assert len(out) == len(lines)
    assert sum(r.first_id != forest.find(r.doc_id) for r in out) == 0


def test_lines_are_cut(spark):
    rows = [(1, "same line of some words here\nown a\n\nlast", "en", "s"), (2, "Same line of some words here \nown b quite different\n\n", "en", "s"), (3, None, "en", "s")]
    docs = frame(spark, rows)
    out = L.deduplicated(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: rows[0][1], 2: "own b quite different\n\n", 3: None}


def test_empty_table(spark):
    assert L.near_duplicate_lines(frame(spark, [])).count() == 0
    assert L.deduplicated(frame(spark, [])).count() == 0


def test_lines_are_cut_as_spark_does(spark):
    texts = [None, "", "\n", " \n\n a\t\r\n\u00a0B ", "\u0130I \u039f\u03a3\n\u03a3", "x" * 9 + "\n  X" + "x" * 8 + "  \n", "\u00c9t\u00e9"]
    docs = frame(spark, [(i, text, "en", "s") for i, text in enumerate(texts)])
    line = F.lower(F.trim("line"))
    cut = docs.where(F.length("text") > 0).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    want = cut.select("doc_id", "line_no", F.when(F.length(line) > 0, F.md5(line)).alias("node"))
    got = L.near_duplicate_lines(docs).select("doc_id", F.col("line_no").cast("int").alias("line_no"), "component")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_a_task_sketches_a_line_once():
    batch = pa.record_batch({"id": [1, 2, 3], "text": ["one line of text\n\none line of text", None, "another\none line of text"]})
    (out,) = L._sketched(L.CHARS, L.BANDS, L.ROWS)([batch])
    assert out.column("id").to_pylist() == [1, 1, 1, 3, 3] and out.column("line_no").to_pylist() == [0, 1, 2, 0, 1]
    node = hashlib.md5(b"one line of text").digest()
    assert [n == node for n in out.column("node").to_pylist()] == [True, False, True, False, True]
    keys = out.column("keys")
    assert keys.is_valid().to_pylist() == [True, False, False, True, False]
    assert S.unpacked(keys)[1].tolist() == [20, 0, 0, 20, 0] and len(keys[0].as_py()) == 20 * S.KEY


def test_keys_of_one_node_only_are_not_shared(spark):
    """Rows of one node in several tasks: counting rows would call all their keys shared."""
    keys = np.arange(12, dtype=np.int64).reshape(4, 3) << 50 | 7  # only the high bytes differ
    keys[3] = [1, 2, 3]
    rows = [(b"a", 0), (b"a", 0), (b"b", 3), (b"c", 3), (b"b", 3)]
    sketch = spark.createDataFrame([(node, S.packed(keys)[row].as_py()) for node, row in rows], "node binary, keys binary").repartition(5)
    found = M.shared_regions(sketch).collect()
    assert sorted(bytes(r.node) for r in found) == [b"b"] * 3 + [b"c"] * 3 and len({r.region for r in found}) == 3
    values, count = S.unpacked(S.packed(keys))
    assert count.tolist() == [3] * 4 and values.reshape(4, 3)[3].tolist() == [1, 2 | 1 << 40, 3 | 2 << 40]
