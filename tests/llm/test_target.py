"""Resampling towards a target distribution against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from corpus_fixtures import alnum, awkward, frame, prose
from cohortflow.llm import target


def grams(text, longest):
    words = alnum(text)
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, bench, longest=1, buckets=10_000, least=20, percent=10):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text, *_ in rows:
        s.update(map(bucket, grams(text, longest)))
    for text in bench:
        t.update(map(bucket, grams(text, longest)))
    S, T = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for doc, text, *_ in rows:
        own = [gain(bucket(g)) for g in grams(text, longest)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(alnum(text)) >= least])
    long = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    for place, r in enumerate(long[: percent * len(long) // 100]):
        r[4] = place + 1
    return [tuple(r[:4]) + (r[4] if not isinstance(r[4], bool) else None,) for r in out]


@pytest.mark.parametrize("longest,buckets,percent", [(1, 10_000, 10), (3, 500, 60), (2, 10_000, 100)])
def test_resampled(spark, longest, buckets, percent):
    rows = awkward(n=200)
    bench = [prose(random.Random(i), 30) for i in range(20)] + [None, ""]
    out = target.resampled(frame(spark, rows).repartition(4), spark.createDataFrame([(t,) for t in bench], "text string"), words=longest, buckets=buckets, percent=percent)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = brute(rows, bench, longest, buckets, percent=percent)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert sum(r[4] is not None for r in want) > 0


def test_empty_tables(spark):
    rows = awkward()
    none = spark.createDataFrame([], "text string")
    out = target.resampled(frame(spark, rows), none)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, brute(rows, [])))
    assert target.resampled(frame(spark, rows).limit(0), none).count() == 0


def test_draw_prefers_the_target(spark):
    rng = random.Random(5)
    good, other = [f"g{i}" for i in range(300)], [f"o{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(good if i % 10 == 0 else other, k=40)), "en", "s") for i in range(1000)]
    bench = spark.createDataFrame([(" ".join(rng.choices(good, k=40)),) for _ in range(100)], "text string")
    docs = frame(spark, rows)
    kept = target.selected(docs, bench)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == 100 and sum(i % 10 == 0 for i in ids) > 70  # 10 by chance


@pytest.mark.parametrize("piece", [1, 3, 16])
def test_pieces_of_long_texts(monkeypatch, piece):
    text = prose(random.Random(8), 300)
    whole = target.features(text.encode(), 3)
    monkeypatch.setattr(target, "PIECE", piece)
    words, counts = target.features(text.encode(), 3)
    assert words == whole[0] == len(alnum(text)) and +counts == +whole[1]
    assert +counts == Counter(zlib.crc32(g.encode()) for g in grams(text, 3))


def test_table_is_the_word_class():
    for byte in range(128):
        folded = chr(byte).lower()
        assert target.TABLE[byte] == (ord(folded) if re.match(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]", folded) else 0x20)
