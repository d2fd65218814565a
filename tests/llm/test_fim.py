"""Fill-in-the-middle against a plain-Python version, and piece tables by hand."""

import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st

from corpus_fixtures import awkward, frame
from cohortflow.llm import fim


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_transformed_and_restored(spark):
    rows = awkward() + [(400 + i, t, "en", "s") for i, t in enumerate(["<P", "a<S>b", "<M>", "<P<S<M", "S>M>P>", "<<<<>>>", "é<", "日本語 text", "a" * 100_000 + "é" * 100_000, "x\r\ny"] * 12)]
    out = fim.restored(fim.transformed(frame(spark, rows).repartition(3))).collect()
    want = sorted(str((d, *brute(d, t), digest(brute(d, t)[-1]), t or "", digest(t or ""))) for d, t, *_ in rows)
    assert sorted(str((r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.output_sha256, r.restored, r.restored_sha256)) for r in out) == want
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert fim.restored(fim.transformed(frame(spark, rows[:1]).limit(0))).count() == 0


def test_pieces_describe_the_output(spark):
    rows = awkward()
    texts = {r[0]: (r[1] or "").encode() for r in rows if r[0] not in (None, 208, 209)}
    for r in fim.transformed(frame(spark, rows)).collect():
        if r.id in texts:
            buffers = (texts[r.id], b"<P><S><M>")
            assert b"".join(buffers[p.buffer][p.start : p.end] for p in r.pieces).decode() == r.output


def test_share_of_forms(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "'some words of text' AS text")
    found = {r.form: r["count"] / 5000 for r in fim.transformed(docs, cut=60, suffix_first=50).groupBy("form").count().collect()}
    assert found == {"plain": pytest.approx(0.4, abs=0.03), "psm": pytest.approx(0.3, abs=0.03), "spm": pytest.approx(0.3, abs=0.03)}


def test_nulls_and_other_columns(spark):
    outputs = spark.createDataFrame([("a", None, "psm"), ("b", "<P>x<S>z<M>y", "psm"), ("c", "same", None), ("d", "", "plain")], "`a.b` string, output string, form string")
    out = {r[0]: r.restored for r in fim.restored(outputs).collect()}
    assert out == {"a": None, "b": "xyz", "c": None, "d": ""}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>PSMa é", max_size=20), st.data())
def test_piece_table(text, data):
    raw = text.encode()
    table = fim.PieceTable.whole(raw)
    places = sorted(data.draw(st.lists(st.integers(0, len(raw)), min_size=2, max_size=2)))
    cut = table.cut(*places)
    assert cut.written() == raw and len(cut.pieces) == 3
    for form in (fim.PSM, fim.SPM):
        arranged = cut.arranged(form)
        assert arranged.restored(form).written() == raw
        assert arranged.sha256() == hashlib.sha256(arranged.written()).hexdigest()
        if not re.search("<[PSM]>", text):
            assert fim.PieceTable.parsed(arranged.written(), form).restored(form).written() == raw
