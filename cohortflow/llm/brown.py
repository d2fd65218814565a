"""Language-model scoring with Brown class-based bigrams.

Words are `[^\\x20\\x09-\\x0D]+` after folding A-Z; every text ends with one end
token. The classes come from exchange clustering of all words that occur at
least `FLOOR` times, so the clustered vocabulary grows with the corpus:

1. Seed. The `TOP` most frequent words, and the endings (`ENDINGS` buckets) of
   all other words, are exchanged on their bigram matrix: a unit moves to the
   class that raises the likelihood of the class bigrams most.
2. Rounds on Spark. Every other word starts in the class of its ending. A round
   counts each word's neighbours by class (a sparse table, shuffled by word) and
   moves each word to the class that its neighbours make likeliest, its own
   counts taken out of its present class; first one half of the words, then the
   other. A round counts if it raises the mutual
   information of the class bigrams by more than `TOLERANCE`; the first that
   does not ends the training, and the better classes stay.

Words below the floor keep the class of their ending: a few occurrences say
more about chance than about class. The texts are read once; rounds read them
as unit numbers, written to the shared folder. Counts are over all training texts.

With c the class of w and c' that of the word before,

    P(w | before) = MIX * T(c | c') * E(w | c) + (1 - MIX) * base(w)
    E(w | c) = (n(w) + 0.1) / (N(c) + 0.1 (V(c) + 1))
    base(w)  = (n(w) + 0.1) / (N + 0.1 (V + 1))

Every class has one unseen word, so P sums to one. E(w | c) / base(w) depends
on the class only. So the score is the base score plus a sum over classes, and
word counts are needed for the base score alone: counts and classes of the most
frequent words are broadcast (at most `HEAD` words, 17 bytes each; only these
move in the rounds), counts of all others are joined.

Defined results: a null text is an empty one, with its end token alone; a null
id is in training (no remainder); equal rows count and score each; without any
training text all words are unseen; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import discard, materialize
from .text import FOLD, SPACED, sliced, text_bytes, words

TOP, ENDINGS, CLASSES = 1000, 256, 64
#: Least count of a word with a class of its own.
FLOOR = 8
#: Words whose counts and classes are broadcast: 17 bytes each.
HEAD = 1 << 19
#: Least relative gain of a round, weight of the class model, added count of a class transition.
TOLERANCE, MIX, ADDED = 0.005, 0.95, 0.5
#: Tokens in a row of unit numbers; ranges of words that are moved together.
CHUNK, BUCKETS = 1024, 512
#: Counts of a moving word: classes behind it, classes before it, itself behind itself.
CELLS = 2 * CLASSES + 1
PRIOR = 0.1
#: Words that a counting task holds before it hands them on.
PENDING = 1_000_000
END = 1  # the end token's key


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 10 == 0, F.lit(False))


def sequence(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, endings, first): all rows' tokens with their end tokens. Row i has
    the tokens first[i] to first[i + 1]; an end token's ending is ENDINGS."""
    data, offsets = text_bytes(column)
    starts, ends, hashes, first = words(data, offsets, SPACED)
    stop = first[1:] + np.arange(len(column))
    is_end = np.zeros(len(hashes) + len(column), dtype=bool)
    is_end[stop] = True
    keys = np.full(len(is_end), END, dtype=np.uint64)
    keys[~is_end] = hashes
    tail = np.zeros(len(starts), dtype=np.uint32)
    for back in (1, 2, 3):
        at = ends - back
        tail = tail * np.uint32(257) + np.where(at >= starts, FOLD[data[np.maximum(at, 0)]].astype(np.uint32) + np.uint32(1), np.uint32(0))
    endings = np.full(len(is_end), ENDINGS, dtype=np.int64)
    endings[~is_end] = (tail * np.uint32(2654435761)) >> np.uint32(24)
    return keys, endings, np.concatenate([[0], stop + 1])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each task's words, in parts of at most `PENDING` words."""
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, endings, n = (np.concatenate(x) for x in zip(*parts))
        found, at, back = np.unique(keys, return_index=True, return_inverse=True)
        return found, endings[at], np.bincount(back, weights=n).astype(np.int64)

    def out() -> pa.RecordBatch:
        keys, endings, n = merged()
        parts.clear()
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(endings), pa.array(n)], ["word", "ending", "n"])

    for batch in sliced(batches, 0):
        keys, endings, _ = sequence(batch.column(0))
        found, at, n = np.unique(keys, return_index=True, return_counts=True)
        parts.append((found, endings[at].astype(np.int32), n.astype(np.int64)))
        if sum(len(p[0]) for p in parts) > 2 * PENDING:
            parts[:] = [merged()]
            if len(parts[0][0]) > PENDING:
                yield out()
    if parts:
        yield out()


def _units(keys: np.ndarray, endings: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Frequent words by their place in `head` (ascending keys), others behind them by ending."""
    if not len(head):
        return endings
    place = np.minimum(np.searchsorted(head, keys), len(head) - 1)
    return np.where((head[place] == keys) & (endings != ENDINGS), place, len(head) + endings)


def _numbered(shared):
    """Texts as rows of unit numbers, each with the unit before its first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        for batch in sliced(batches, 0):
            keys, endings, _ = sequence(batch.column(0))
            units = np.concatenate([[len(head) + ENDINGS], _units(keys, endings, head)]).astype(np.int32)
            rows = [units[at : at + CHUNK + 1].tobytes() for at in range(0, len(units) - 1, CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["units"])

    return run


def _bigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(before, unit) of all tokens in rows of unit numbers."""
    rows = [np.frombuffer(row, np.int32) for row in column.to_pylist()]
    if not rows:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate([r[:-1] for r in rows]), np.concatenate([r[1:] for r in rows])


def _paired(shared, size: int):
    """Bigram counts of seed units, as sparse rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed_of = shared.value
        pairs = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            before, units = _bigrams(batch.column(0))
            pairs += np.bincount(seed_of[before] * size + seed_of[units], minlength=size * size)
        pairs = pairs.reshape(size, size)
        for at in range(0, size, 128):
            rows = [row for row in range(at, min(at + 128, size)) if pairs[row].any()]
            cols = [np.flatnonzero(pairs[row]) for row in rows]
            columns = [
                pa.array(rows, pa.int32()),
                pa.array([c.astype(np.int32).tobytes() for c in cols], pa.binary()),
                pa.array([pairs[row][c].tobytes() for row, c in zip(rows, cols)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["unit", "cols", "n"])

    return run


def _summed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for unit, cols, n in zip(*(batch.column(c).to_pylist() for c in range(3))):
                row = total.setdefault(unit, np.zeros(size, dtype=np.int64))
                row[np.frombuffer(cols, np.int32)] += np.frombuffer(n, np.int64)
        if total:
            columns = [pa.array(list(total), pa.int32()), pa.array([row.tobytes() for row in total.values()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["unit", "n"])

    return run


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def information(block: np.ndarray) -> float:
    """Mutual information of class bigrams, times their number."""
    block = block.astype(np.float64)
    return float(_f(block).sum() - _f(block.sum(1)).sum() - _f(block.sum(0)).sum() + _f(block.sum()))


def exchange(pairs: np.ndarray, classes: int = CLASSES, tolerance: float = TOLERANCE) -> np.ndarray:
    """Classes of the units of a bigram count matrix, by the exchange algorithm;
    ends with the first round that gains less than `tolerance`."""
    n = pairs.astype(np.float64)
    size = len(n)
    order = np.argsort(-(n.sum(0) + n.sum(1)), kind="stable")
    own = np.empty(size, dtype=np.int64)
    own[order] = np.arange(size) % classes
    member = np.zeros((size, classes))
    member[np.arange(size), own] = 1
    right, left = n @ member, n.T @ member  # of each unit: counts with each class behind it, before it
    block = member.T @ right
    reached = information(block)
    while True:
        for u in order:
            a = own[u]
            loop = n[u, u]
            out, into = right[u].copy(), left[u].copy()
            out[a] -= loop
            into[a] -= loop
            block[a, :] -= out
            block[:, a] -= into
            block[a, a] -= loop
            rows, cols = block.sum(1), block.sum(0)
            whole = _f(block)
            gain = (_f(block + out[None, :]) - whole).sum(1) + (_f(block + into[:, None]) - whole).sum(0)
            cell = np.diag(block)
            gain += _f(cell + out + into + loop) - _f(cell + out) - _f(cell + into) + _f(cell)
            gain -= _f(rows + n[u].sum()) - _f(rows) + _f(cols + n[:, u].sum()) - _f(cols)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            block[b, :] += out
            block[:, b] += into
            block[b, b] += loop
            if a != b:
                own[u] = b
                right[:, a] -= n[:, u]
                right[:, b] += n[:, u]
                left[:, a] -= n[u, :]
                left[:, b] += n[u, :]
        before, reached = reached, information(block)
        if reached <= before * (1 + tolerance) + 1e-6:
            return own


def _blocks(shared):
    """Class bigram counts of a task's tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.astype(np.int64)
        block = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        for batch in batches:
            before, units = _bigrams(batch.column(0))
            block += np.bincount(own[before] * CLASSES + own[units], minlength=CLASSES * CLASSES)
        at = np.flatnonzero(block)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(block[at])], ["cell", "n"])

    return run


def class_bigrams(units: DataFrame, own: np.ndarray) -> np.ndarray:
    shared = units.sparkSession.sparkContext.broadcast(own)
    block = np.zeros(CLASSES * CLASSES, dtype=np.int64)
    for row in units.mapInArrow(_blocks(shared), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        block[row.cell] = row.n
    return block.reshape(CLASSES, CLASSES)


def _neighbours(shared, width: int):
    """Counts of the moving words' neighbours by class: packets (bucket, steps
    between ascending cells, n) for ranges of `width` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, moving = shared.value
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            cells, n = (np.concatenate(x) for x in zip(*parts))
            found, back = np.unique(cells, return_inverse=True)
            return found, np.bincount(back, weights=n).astype(np.int64)

        def packets() -> pa.RecordBatch:
            cells, n = merged()
            parts.clear()
            bucket = cells // (width * CELLS)
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(cells)]
            spans = [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
            columns = [
                pa.array([int(bucket[a]) for a, _ in spans], pa.int32()),
                pa.array([np.diff(cells[a:b], prepend=bucket[a] * width * CELLS).astype(np.uint32).tobytes() for a, b in spans], pa.binary()),
                pa.array([n[a:b].astype(np.int64).tobytes() for a, b in spans], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["bucket", "steps", "n"])

        for batch in batches:
            before, units = _bigrams(batch.column(0))
            before, units = before.astype(np.int64), units.astype(np.int64)
            same = before == units
            behind = before * CELLS + np.where(same, 2 * CLASSES, own[units])
            ahead = units * CELLS + CLASSES + own[before]
            found, n = np.unique(np.concatenate([behind[moving[before]], ahead[moving[units] & ~same]]), return_counts=True)
            parts.append((found, n))
            if sum(len(p[0]) for p in parts) > 2 * PENDING:
                parts[:] = [merged()]
                if len(parts[0][0]) > PENDING:
                    yield packets()
        if parts:
            yield packets()

    return run


def best_classes(cells: np.ndarray, own: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The class that each word's neighbours make likeliest. cells: a row of
    `CELLS` counts per word; own: present classes; block: class bigrams."""
    out, into, loop = cells[:, :CLASSES].astype(float), cells[:, CLASSES : 2 * CLASSES].astype(float), cells[:, 2 * CLASSES].astype(float)
    block, added, whole = block.astype(float), ADDED, ADDED * CLASSES
    rows, cols = block.sum(1), block.sum(0)
    after = np.log(block + added) - np.log(rows + whole)[:, None]  # of a class, given the one before it
    ahead = np.log(block + added) - np.log(cols + whole)[None, :]
    cell = np.log(np.diag(block) + added) - np.log(rows + whole) - np.log(cols + whole)
    value = out @ after.T + into @ ahead + loop[:, None] * cell[None, :]
    at = np.arange(len(own))
    inner = block[own, own] - out[at, own] - into[at, own] - loop
    n_out, n_in = out.sum(1) + loop, into.sum(1) + loop
    left_out, left_in = block[own] - out, block[:, own].T - into
    left_out[at, own] = left_in[at, own] = inner
    row = np.log(np.maximum(rows[own] - n_out, 0) + whole)
    col = np.log(np.maximum(cols[own] - n_in, 0) + whole)
    stay = (out * (np.log(np.maximum(left_out, 0) + added) - row[:, None])).sum(1)
    stay += (into * (np.log(np.maximum(left_in, 0) + added) - col[:, None])).sum(1)
    stay += loop * (np.log(np.maximum(inner, 0) + added) - row - col)
    value[at, own] = stay
    best = value.argmax(1)
    return np.where(value[at, best] > stay + 1e-9, best, own)


def _moved(shared, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, moving, block = shared.value
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for bucket, steps, n in zip(*(batch.column(c).to_pylist() for c in range(3))):
                cells = total.setdefault(bucket, np.zeros(width * CELLS, dtype=np.int64))
                cells[np.cumsum(np.frombuffer(steps, np.uint32).astype(np.int64))] += np.frombuffer(n, np.int64)
        for bucket, cells in total.items():
            old = own[bucket * width : (bucket + 1) * width]
            go = moving[bucket * width : (bucket + 1) * width]
            new = np.where(go, best_classes(cells.reshape(width, CELLS)[: len(old)], old.astype(np.int64), block), old)
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([new.astype(np.uint8).tobytes()], pa.binary())], ["bucket", "own"])

    return run


def moved(units: DataFrame, own: np.ndarray, moving: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Classes after one round in which every moving word may change its class."""
    spark = units.sparkSession
    width = max(1, -(-len(own) // BUCKETS))
    shared = spark.sparkContext.broadcast((own, moving))
    state = spark.sparkContext.broadcast((own, moving, block))
    packets = units.mapInArrow(_neighbours(shared, width), "bucket int, steps binary, n binary")
    parts = min(BUCKETS, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    out = own.copy()
    for row in packets.repartition(parts, "bucket").mapInArrow(_moved(state, width), "bucket int, own binary").collect():  # a byte per word
        new = np.frombuffer(row.own, np.uint8)
        out[row.bucket * width : row.bucket * width + len(new)] = new
    return out


@dataclass
class Model:
    """What scoring needs, of bounded size: the most frequent words (ascending
    keys) with their counts, the class of each unit (those words, then the
    endings, then the end token), log10 of the factor on the base probability by
    class pair, and corpus totals."""

    head: np.ndarray
    head_n: np.ndarray
    own: np.ndarray
    factor: np.ndarray
    tokens: int
    types: int
    ends: int


def head_level(sizes: list[tuple[int, int]], limit: int) -> int:
    """The lowest level (log2 steps of a count) from which on at most `limit`
    words are left. sizes: (level, words)."""
    total, level = 0, max((lv for lv, _ in sizes), default=0) + 1
    for lv, n in sorted(sizes, reverse=True):
        total += n
        if total > limit:
            break
        level = lv
    return level


def seeded(units: DataFrame, n: np.ndarray, endings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(classes of all units, whether a unit is a seed) from the exchange of the
    most frequent words and of the other words' endings. n, endings: of the head words."""
    context = units.sparkSession.sparkContext
    top = np.sort(np.argsort(-n, kind="stable")[:TOP])
    size = len(top) + ENDINGS + 1
    seed_of = len(top) + np.concatenate([endings, np.arange(ENDINGS + 1)])
    seed_of[top] = np.arange(len(top))
    rows = units.mapInArrow(_paired(context.broadcast(seed_of), size), "unit int, cols binary, n binary")
    parts = max(8, int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pairs = np.zeros((size, size), dtype=np.int64)
    for row in rows.repartition(parts, "unit").mapInArrow(_summed(size), "unit int, n binary").collect():
        pairs[row.unit] = np.frombuffer(row.n, np.int64)
    seeds = np.zeros(len(seed_of), dtype=bool)
    seeds[top] = True
    return exchange(pairs)[seed_of].astype(np.uint8), seeds


def train(docs: DataFrame, text_col: str = "text", head: int = HEAD, floor: int = FLOOR) -> tuple[Model, DataFrame]:
    """The model of `docs`, and all word counts as a table (word, ending, n)."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.col(text_col).alias("text"))
    counts = texts.mapInArrow(_counted, "word long, ending int, n long").groupBy("word").agg(F.any_value("ending").alias("ending"), F.sum("n").alias("n"))
    counts = materialize(counts, "counts")
    level = F.floor(F.log2("n") * 4).cast("int")
    by_ending = {r.ending: (r.types, r.n) for r in counts.groupBy("ending").agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("n")).collect()}
    tokens, types = sum(n for _, n in by_ending.values()), sum(t for t, _ in by_ending.values())
    lowest = head_level([(r.level, r["count"]) for r in counts.groupBy(level.alias("level")).count().collect()], head)
    frequent = counts.where((F.col("ending") < ENDINGS) & (level >= lowest)).toPandas()
    keys = frequent.word.to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, n, endings = keys[order], frequent.n.to_numpy().astype(np.int64)[order], frequent.ending.to_numpy().astype(np.int64)[order]

    units = materialize(texts.mapInArrow(_numbered(context.broadcast(keys)), "units binary"), "units")
    own, seeds = seeded(units, n, endings)
    moving = np.concatenate([n >= floor, np.zeros(ENDINGS + 1, dtype=bool)]) & ~seeds
    block = class_bigrams(units, own)
    while moving.any():
        new, new_block = own, block
        for half in (0, 1):  # words that move together do not chase each other
            new = moved(units, new, moving & (np.arange(len(moving)) % 2 == half), new_block)
            new_block = class_bigrams(units, new)
        gained = information(new_block) > information(block) * (1 + TOLERANCE) + 1e-6
        if information(new_block) > information(block):
            own, block = new, new_block
        if not gained:
            break
    discard(units)

    unit_types = np.concatenate([np.ones(len(keys)), np.zeros(ENDINGS), [1]])
    rest = np.array([by_ending.get(e, (0, 0))[0] for e in range(ENDINGS)]) - np.bincount(endings, minlength=ENDINGS)
    unit_types[len(keys) : len(keys) + ENDINGS] = rest
    class_types, class_tokens = np.bincount(own, weights=unit_types, minlength=CLASSES), block.sum(0)
    change = (block + ADDED) / (block.sum(1, keepdims=True) + ADDED * CLASSES)
    lift = (tokens + PRIOR * (types + 1)) / (class_tokens + PRIOR * (class_types + 1))
    return Model(keys, n, own, np.log10(MIX * change * lift[None, :] + 1 - MIX), tokens, types, by_ending.get(ENDINGS, (0, 0))[1]), counts


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        end = model.own[-1]
        row = TaskContext.get().partitionId() << 40
        for batch in sliced(batches, 1):
            keys, endings, first = sequence(batch.column(1))
            found, at, back = np.unique(keys, return_index=True, return_inverse=True)
            unit = _units(found, endings[at], model.head)
            classes = model.own[unit][back]
            lead = np.concatenate([[end], classes[:-1]])
            lead[first[:-1]] = end
            n = np.concatenate([model.head_n, np.zeros(ENDINGS, np.int64), [model.ends]])[unit]
            known = (n > 0)[back]
            logs = np.where(known, np.log10(n + PRIOR)[back], 0.0)
            total = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  every row has an end token
            rest = np.flatnonzero(~known)
            rest_at = np.searchsorted(rest, first).astype(np.int32)
            columns = [
                pa.array(np.arange(batch.num_rows, dtype=np.int64) + row),
                batch.column(0),
                pa.array(np.diff(first)),
                pa.array(total(known.astype(np.int64))),
                pa.array(total(logs)),
                pa.array(total(model.factor[lead, classes])),
                pa.ListArray.from_arrays(rest_at, pa.array(keys[rest].view(np.int64))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "n_tokens", "n_known", "logs", "lift", "rest"])
            row += batch.num_rows

    return run


def scored(docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id_col, n_tokens, n_known, train_tokens,
    base_score, score (log10) and perplexity of the text under the model."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"row long, id {kind}, n_tokens long, n_known long, logs double, lift double, rest array<long>"
    rows = materialize(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_scored(shared), schema), "scored")
    rest = rows.select("row", F.explode("rest").alias("word")).groupBy("row", "word").agg(F.count(F.lit(1)).alias("times"))
    rest = rest.join(counts.select("word", "n"), "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + PRIOR)).alias("more_logs"),
    )
    out = rows.drop("rest").join(rest, "row", "left")
    norm = float(np.log10(model.tokens + PRIOR * (model.types + 1)))
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(norm)
    score = base + F.col("lift")
    return out.select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
