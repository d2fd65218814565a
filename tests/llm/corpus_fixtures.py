"""Small documents with every awkward case, and plain-Python versions of the shared definitions."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, id string, node string, region long, row string, word string, key string, keys string, n int, size int, copies int"

_UPPER = {c: c + 32 for c in range(65, 91)}


def lower(text: str | None) -> str:
    return (text or "").translate(_UPPER)


def spaced(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def alnum(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def prose(rng: random.Random, n: int) -> str:
    syllables = ["an", "the", "ion", "é", "ß", "re", "st", "wh", "ou", "日", "i", "K", "Ñ"]
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", ", ", ".\n", "\t", "\x0b", "\xa0 "]) for w in words)


def awkward(seed: int = 1, n: int = 40) -> list[tuple]:
    """(doc_id, text, lang, source): nulls in every column, empty and blank texts, a very long one,
    copies, near copies, repeated rows, one word texts and a hot source."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(1, 60)), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(n)]
    base = prose(rng, 80).split()
    for j in range(12):
        near = list(base)
        if j > 3:
            near[rng.randrange(len(near))] = "changed"
        rows.append((100 + j, " ".join(near), "en", "hot"))
    rows += [
        (200, None, "en", "s1"), (201, "", "en", "s1"), (202, " \n\t ", "de", None), (203, "one", None, "s2"), (204, "ONE", "en", "s2"),
        (205, "two words", "en", "s2"), (206, prose(rng, 9000), "en", "long"), (207, "x" * 5000, "en", "long"),
        (208, "same row", "en", "s1"), (208, "same row", "en", "s1"), (209, "first text of the id", "en", "s1"), (209, "second text of the id", "en", "s1"),
        (None, "no id here at all", "en", "s1"), (None, None, None, None), (210, "a\x00b \x1f c\x85d   ", "en", ""),
    ]
    return rows


def frame(spark, rows: list[tuple]):
    full = [(*row, len(row[1] or ""), *("x" for _ in range(2)), 1, *("y" for _ in range(4)), 1, 2, 3) for row in rows]
    return spark.createDataFrame(full, SCHEMA)
