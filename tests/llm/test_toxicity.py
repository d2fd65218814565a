"""Toxicity lexicon: folding, learning, exceptions, held-out accuracy."""

import random
import time

from pyspark.sql import functions as F

from corpus_fixtures import awkward, frame, prose
from cohortflow.llm import toxicity as T


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        text = prose(rng, rng.randint(20, 200))
        bad = i % 5 == 0
        if bad:
            at = rng.randrange(len(text))
            text = f"{text[:at]} {rng.choice(['grumbler', 'Grυmblеr', 'grumb1er', 'swindleheit', 'swindleung'])} {text[at:]}"
        elif i % 80 == 1:
            text += " toy grumbler box"
        rows.append((i, text, "en", "s"))
        labels.append((i, int(bad)))
    return rows, labels


def test_folding():
    assert T.fold("Tr4sh, ТRАSH tra​sh").split() == ["trash"] * 3
    assert T.fold(None).split() == []


def test_learned_lexicon(spark):
    rows, labels = corpus()
    docs, table = frame(spark, rows), spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")
    lexicon = T.learn(docs, table)
    assert any(p.startswith(" swindie") for p in lexicon.weights)  # l and 1 fold to i
    assert all(not p.startswith(" toy") for p in lexicon.weights)
    scores = {r.doc_id: r["__tox_score"] for r in T.scored(docs, lexicon).collect()}
    right = sum((scores[d] >= 0.5) == bool(y) for d, y in labels)
    assert right >= 0.97 * len(labels)


def test_exception_phrases():
    lexicon = T.Lexicon({" grumbier ": 5.0, " swind": 4.0}, (" toy grumbier ",), (-3.0, 2.0, 1.0))
    automaton = lexicon.matcher()
    assert T.features(automaton, "A toy grumbler here") == (0, 4)
    assert T.features(automaton, "a grumbler, a toy grumbler; swindles") == (9.0, 6)
    assert T.features(T.Lexicon().matcher(), "anything") == (0, 1)


def naive_matches(lexicon, folded):
    """Every pattern at every position, every match against every exception phrase."""
    at = lambda p: [i for i in range(len(folded)) if folded.startswith(p, i)]
    spared = [(i, i + len(p)) for p in lexicon.exceptions for i in at(p)]
    found = [(i, i + len(p), w) for p, w in lexicon.weights.items() for i in at(p)]
    return sorted((a, b, w) for a, b, w in found if not any(x <= a + 1 and b - 1 <= y for x, y in spared))


def test_matches_against_a_naive_scan():
    rng = random.Random(11)
    words = ["a", "ab", "abb", "ba", "bab", "bb", "abab"]
    for _ in range(300):
        weights = {f" {rng.choice(words)}{rng.choice([' ', ''])}": rng.random() for _ in range(rng.randint(0, 4))}
        spared = {f" {rng.choice(words)} {rng.choice(words)} " for _ in range(rng.randint(0, 4))}
        lexicon = T.Lexicon(weights, tuple(sorted(spared)))
        folded = T.fold(" ".join(rng.choices(words, k=rng.randint(0, 30))))
        assert sorted(T.matches(lexicon.matcher(), folded)) == naive_matches(lexicon, folded)


def test_neighbours_of_matches():
    lexicon = T.Lexicon({" bad ": 4.0, " wor": 4.0})
    long = "x" * 3000
    assert T._phrases(lexicon)(f"bad  {long} worse, bad") == {f" bad {long} ", f" {long} worse ", " worse bad "}
    assert T._phrases(lexicon)("a\xa0bad b\xa0worse") == set()  # only a plain space begins a pattern
    assert T._phrases(lexicon)("a\xa0b bad c\xa0d") == {" b bad ", " bad c "}
    assert T._phrases(lexicon)("fine") == set() == T._phrases(lexicon)(None)


def test_time_grows_with_the_text():
    """A match and a spared phrase in every few words of 2 MB."""
    lexicon = T.Lexicon({" grumbier ": 5.0, " swind": 4.0}, (" toy grumbier ",), (-3.0, 2.0, 1.0))
    automaton, of = lexicon.matcher(), T._phrases(lexicon)
    text = "a toy grumbler, the swindles of a grumbler; " * 48_000
    began = time.process_time()
    assert T.features(automaton, text)[0] == 9.0 * 48_000
    assert of(text) == {" the swindies ", " swindies of ", " a grumbier ", " grumbier a "}
    assert time.process_time() - began < 10


def test_length_normalised():
    curve = T.fit_curve(*(__import__("numpy").array(x, float) for x in ([5, 5, 0, 0, 9, 0], [10, 400, 10, 400, 50, 50], [1, 0, 0, 0, 1, 0])))
    score = lambda total, n: float(T._inputs(*(__import__("numpy").array([x], float) for x in (total, n)))[0] @ curve)
    assert score(5, 10) > score(5, 400) > score(0, 400) - 1e-9


def test_rows_pass_through(spark):
    docs = frame(spark, awkward())
    rows, labels = corpus()
    lexicon = T.learn(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    out = T.scored(docs, lexicon)
    assert out.columns == [*docs.columns, "__tox_score"] and out.count() == docs.count()
    assert out.where("not (__tox_score between 0 and 1)").count() == 0
    dotted = spark.createDataFrame([("a text", 1)], "text string, `a.b` int")
    assert [tuple(r)[:2] for r in T.scored(dotted, lexicon).collect()] == [("a text", 1)]
    empty = [r["__tox_score"] for r in out.where("text is null or text = ''").collect()]
    assert len(set(empty)) == 1 and empty[0] < 0.5


def test_nothing_to_learn(spark):
    docs, none = frame(spark, awkward()), spark.createDataFrame([], "doc_id long, toxic int")
    assert T.learn(docs, none) == T.Lexicon()
    assert T.without_toxic(docs, none).count() == docs.count()
    assert T.scored(frame(spark, []), T.Lexicon()).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = T.held_out(F.col("doc_id"))
    lexicon = T.learn(docs, labels, usable=~out)
    scored = T.scored(docs.where(out), lexicon).join(labels, "doc_id").select((F.col("__tox_score") >= 0.5).cast("int").alias("p"), "toxic")
    counts = {(r.p, r.toxic): r["count"] for r in scored.groupBy("p", "toxic").count().collect()}
    assert counts[1, 1] / (counts[1, 1] + counts.get((0, 1), 0)) > 0.85
    assert counts[1, 1] / (counts[1, 1] + counts.get((1, 0), 0)) > 0.95
