"""Byte-level BPE against the public library, on every code point, awkward texts and random mixes."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st

from corpus_fixtures import awkward, frame
from cohortflow.llm import byte_bpe, queries
from cohortflow.llm.text import text_bytes

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = byte_bpe.Vocabulary(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={})
BYTES = {bytes([i]): i for i in range(256)}


def own(texts: list[str | None]) -> list[list[int]]:
    ids, first = VOCABULARY.encoded(*text_bytes(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(first, first[1:])]


def cut(texts: list[str]) -> list[bytes]:
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    starts = [*byte_bpe.slices(data, offsets).tolist(), len(data)]
    return [data[a:b].tobytes() for a, b in zip(starts, starts[1:])]


def test_classes_are_the_library_s():
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    kind = byte_bpe.classes()
    for pattern, symbol in ((r"\p{L}", byte_bpe.LETTER), (r"\p{N}", byte_bpe.NUMBER), (r"\s", byte_bpe.RUN)):
        found = tiktoken.Encoding("x", pat_str=pattern, mergeable_ranks=BYTES, special_tokens={}).encode_ordinary(every)
        assert {c for c in every if kind[ord(c)] == symbol} == set(bytes(found).decode())


PARTS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'r", "'l", "'S", "''", "'", " ", "  ", "\n", "\r\n", "\t", "\xa0", "　", "a", "é", "日本", "7", "½", "!", "…", "\x1c", "\x00", "re", "e", "l"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=14).map("".join), max_size=5))
def test_slices_are_the_pattern_s(texts):
    assert cut(texts) == [m.encode() for t in texts for m in regex.findall(public_tokenizers.PATTERN, t)]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64])
def test_pieces_hand_on_their_state(monkeypatch, piece):
    rng = random.Random(piece)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 60))) for _ in range(40)]
    want = [m.encode() for t in texts for m in regex.findall(public_tokenizers.PATTERN, t)]
    monkeypatch.setattr(byte_bpe, "PIECE", piece)
    assert cut(texts) == want


def test_ids_are_the_library_s():
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS + ["the ", "Ünïcode ", "ing "], k=rng.randint(0, 200))) for _ in range(300)]
    texts += ["x" * 20_000, " " * 30_000 + "a", "\n" * 5001, "ab" * 4000, "日" * 3000, "", "<|endoftext|>", "a\U0001f600b"]
    assert own(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED", 3)
    texts = ["one two three four five six one two three", "six five four one"] * 3
    assert own(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_encoded_and_decoded(spark):
    rows = awkward()
    docs = frame(spark, rows).repartition(3)
    out = byte_bpe.decoded(byte_bpe.encoded(docs, RANKS), RANKS).collect()
    assert len(out) == len(rows)
    left = sorted((str(d), t or "") for d, t, *_ in rows)
    assert sorted((str(r.id), bytes(r.decoded).decode()) for r in out) == left
    for r in out:
        text = bytes(r.decoded)
        assert r.ids == LIBRARY.encode_ordinary(text.decode())
        assert [text[a:b] for a, b in zip(r.offsets, r.offsets[1:])] == [LIBRARY.decode_single_token_bytes(i) for i in r.ids]
        assert r.offsets[0] == 0 and r.offsets[-1] == len(text)
    assert byte_bpe.decoded(byte_bpe.encoded(docs.limit(0), RANKS), RANKS).count() == 0


def test_decoding_lists_of_their_own(spark, monkeypatch):
    lists = spark.createDataFrame([("a", [64, 65]), ("b", None), ("c", []), ("d", list(range(300)))], "id string, ids array<int>")
    out = {r.id: bytes(r.decoded) for r in byte_bpe.decoded(lists.coalesce(1), RANKS).collect()}
    assert out == {"a": LIBRARY.decode_bytes([64, 65]), "b": b"", "c": b"", "d": LIBRARY.decode_bytes(list(range(300)))}
    for bad in ([-1], [10**6], [None]):
        with pytest.raises(Exception, match="not in the vocabulary"):
            byte_bpe.decoded(spark.createDataFrame([("a", bad)], "id string, ids array<int>"), RANKS).collect()


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    out = queries.op12_byte_bpe(spark, sf).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert np.sum([r.n_tokens for r in out]) > 0
