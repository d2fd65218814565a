"""The pipeline's stages in order, by brute force where they decide, and the registered queries."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as P
from corpus_fixtures import frame, awkward
from test_minhash_forest import brute
from test_operators import hits
from cohortflow.llm import queries

SF = "/root/testdata/sf0.01"


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(entry.oracle_sql()) <= set(names)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages = dict(P.STAGES)
    assert len(stages) == 5
    calm = stages["toxicity"](spark, docs, SF)
    assert calm.columns == docs.columns and 0.8 * docs.count() < calm.count() < docs.count()
    rows = [(r.doc_id, r.text) for r in calm.collect()]
    one = stages["minhash_near_dedup"](spark, calm, SF)
    roots, _ = brute(rows, 5, 80)
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(roots.values()))
    left = [r for r in rows if r[0] in set(roots.values())]
    clean = stages["benchmark_decontamination"](spark, one, SF)
    want = sorted(d for d, t in left if not any(hits(t, bench)[0]))
    assert sorted(r.doc_id for r in clean.collect()) == want
    mix = stages["mix_sources"](spark, clean, SF)
    assert mix.columns == docs.columns
    copies = Counter(r.doc_id for r in mix.collect())
    assert set(copies) <= set(want) and max(copies.values()) <= 2
    out = stages["token_files"](spark, mix, SF).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = dict(rows)
    start = 0
    for doc, row in zip(sorted(copies.elements()), out, strict=True):
        ids = tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [1]
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    whole = P.run(spark, SF).collect()
    assert sorted(whole) == sorted(out)


def test_stages_take_awkward_and_empty_tables(spark):
    for rows in (awkward(), []):
        docs = frame(spark, rows)
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            if name != "token_files":
                assert out.columns == docs.columns
            if not rows:
                assert out.count() == 0
            else:
                assert out.count() > 0
