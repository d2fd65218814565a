"""Byte-level BPE with vectorised pre-tokenisation.

Pre-tokens are those of the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

and are found without it. Every code point has a class; a few letters and
white space get a symbol that also tells what follows them in the text. An
automaton of eight states reads the symbols: it knows the kind of the pre-token
it is in, an apostrophe that may begin a contraction, and a space that joins
the next run. A symbol is a function from states to states, and composition of
functions is associative, so the states before all code points come from a
scan: blocks compose their functions side by side, block results are chained,
and states are read back inside the blocks. Where a text starts, a constant
function resets the automaton. State and symbol tell whether a pre-token
starts. Pieces of a very long text hand on their last state.

Each distinct slice is merged once per worker: pairs of lowest rank first,
leftmost first among equal ones; a very long slice uses a heap, so it is no
worse than n log n. Ids come with the byte offset of each token, and with these
an id list is decoded, whole or in part.

Defined results: a null text is an empty one, without ids; a null id list
decodes to no bytes, an id that is null or outside the vocabulary raises; extra columns are
ignored; null and repeated document ids keep their rows; an empty table gives
an empty result.
"""

from __future__ import annotations

import base64
import functools
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import sliced, text_bytes

#: Bytes of text scanned, and ids decoded, at a time; code points composed in one block.
PIECE, BLOCK = 1 << 20, 128
#: Distinct slices that one worker remembers: this many new ones or so many bytes of them, and as many from before;
#: slices looked up at a time.
CACHED, CACHED_BYTES, SLICES = 400_000, 32 << 20, 100_000
#: Slices of up to so many bytes are merged in a list, longer ones from a heap.
SHORT_SLICE = 100

# Symbols. LETTER is any letter; SHORT ends a contraction by itself (s, t, m, d); LONG is the first letter
# of re, ve or ll with the second behind it. RUN is white space before white space or the end of the
# text, LAST other white space before a visible code point, SPACE a blank before one.
LETTER, SHORT, LONG, NUMBER, OTHER, QUOTE, RUN, LAST, SPACE = range(9)
SYMBOLS = 9
# States: BREAK, the next code point starts a pre-token; HELD, an apostrophe began one; SECOND, a
# contraction lacks its last letter; JOIN, a blank that the next run takes in.
BREAK, IN_LETTERS, IN_NUMBERS, IN_OTHERS, HELD, SECOND, IN_RUN, JOIN = range(8)
STATES = 8


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a pre-token starts) by symbol and state; from symbol SYMBOLS on,
    the same symbols at the start of a text."""
    step = np.zeros((2 * SYMBOLS, STATES), dtype=np.uint8)
    starts = np.ones((2 * SYMBOLS, STATES), dtype=bool)
    for symbol, state in (
        (LETTER, IN_LETTERS), (SHORT, IN_LETTERS), (LONG, IN_LETTERS), (NUMBER, IN_NUMBERS),
        (OTHER, IN_OTHERS), (QUOTE, HELD), (RUN, IN_RUN), (LAST, BREAK), (SPACE, JOIN),
    ):
        step[symbol] = state
    going_on = [(s, IN_LETTERS, IN_LETTERS) for s in (LETTER, SHORT, LONG)] + [(s, JOIN, IN_LETTERS) for s in (LETTER, SHORT, LONG)]
    going_on += [(s, SECOND, BREAK) for s in (LETTER, SHORT, LONG)] + [(SHORT, HELD, BREAK), (LONG, HELD, SECOND)]
    going_on += [(NUMBER, IN_NUMBERS, IN_NUMBERS), (NUMBER, JOIN, IN_NUMBERS), (RUN, IN_RUN, IN_RUN)]
    going_on += [(s, state, IN_OTHERS) for s in (OTHER, QUOTE) for state in (IN_OTHERS, JOIN, HELD)]
    for symbol, state, then in going_on:
        step[symbol, state], starts[symbol, state] = then, False
    step[SYMBOLS:] = step[:SYMBOLS, :1]  # as from BREAK, whatever the text before left
    return step, starts


STEP, STARTS = _automaton()

# Letters and digits of Unicode 16 that the running Python's tables (15.1) may lack.
LATER_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
LATER_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))


@functools.cache
def classes() -> np.ndarray:
    """The symbol of every code point by itself: LETTER, NUMBER, RUN (white space) or OTHER."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for ranges, kind in ((LATER_LETTERS, LETTER), (LATER_NUMBERS, NUMBER)):
        for low, high in ranges:
            out[low : high + 1] = kind
    space = [c for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c <= 0x1F]
    out[space] = RUN
    out[ord("'")] = QUOTE
    return out


_SHORT = np.isin(np.arange(128), [ord(c) for c in "stmd"])
_THEN = np.zeros(128, dtype=np.uint32)
for _first, _second in ("re", "ve", "ll"):
    _THEN[ord(_first)] = ord(_second)


def symbols(points: np.ndarray, first: np.ndarray, following: int | None) -> np.ndarray:
    """The symbols of a run of code points. `first` marks where texts start;
    `following` is the code point behind the run in the same text, if any."""
    out = classes()[points]
    after = np.append(points[1:], np.uint32(following or 0))
    ends = np.append(first[1:], following is None)
    ascii_ = np.flatnonzero((points < 128) & (out == LETTER))
    letter = points[ascii_]
    out[ascii_[_SHORT[letter]]] = SHORT
    out[ascii_[(_THEN[letter] != 0) & (_THEN[letter] == after[ascii_]) & ~ends[ascii_]]] = LONG
    blank = np.flatnonzero(out == RUN)
    visible = ~ends[blank] & (classes()[after[blank]] != RUN)
    out[blank[visible]] = np.where(points[blank[visible]] == 0x20, SPACE, LAST)
    out[first] += SYMBOLS
    return out


def states_before(symbol: np.ndarray, state: int) -> np.ndarray:
    """The automaton's state before each symbol, and after the last, from `state`."""
    n = len(symbol)
    rows = -(-n // BLOCK)
    filled = np.zeros(rows * BLOCK, dtype=np.uint8)
    filled[:n] = symbol
    table = filled.reshape(rows, BLOCK)
    flat, base = STEP.reshape(-1), np.arange(STATES, dtype=np.intp)
    # Every block's prefixes as functions of the state before the block.
    prefix = np.empty((BLOCK, rows, STATES), dtype=np.uint8)
    now = np.broadcast_to(base.astype(np.uint8), (rows, STATES))
    for j in range(BLOCK):
        now = flat[table[:, j, None].astype(np.intp) * STATES + now]
        prefix[j] = now
    entry = np.empty(rows, dtype=np.intp)
    for block, whole in enumerate(now.tolist()):
        entry[block] = state
        state = whole[state]
    after = np.take_along_axis(prefix, np.broadcast_to(entry[None, :, None], (BLOCK, rows, 1)), 2)[:, :, 0].T.reshape(-1)
    return np.concatenate([entry[:1].astype(np.uint8), after[:n]])


def slices(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The byte places where the pre-tokens of all rows start. `data` is UTF-8;
    row i is data[offsets[i]:offsets[i + 1]]."""
    found, state, at = [], BREAK, 0
    texts = offsets[:-1][np.diff(offsets) > 0]
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        piece = data[at:end].tobytes()
        points = np.frombuffer(piece.decode().encode("utf-32-le"), dtype="<u4")
        places = np.flatnonzero((data[at:end] & 0xC0) != 0x80)
        first = np.zeros(len(points), dtype=bool)
        first[np.searchsorted(places, texts[np.searchsorted(texts, at) : np.searchsorted(texts, end)] - at)] = True
        same = end < len(data) and texts[np.searchsorted(texts, end) % len(texts)] != end
        following = ord(data[end : end + 4].tobytes().decode(errors="ignore")[0]) if same else None
        symbol = symbols(points, first, following)
        states = states_before(symbol, state)
        found.append(places[STARTS[symbol, states[:-1]]] + at)
        state, at = int(states[-1]), end
    return np.concatenate(found) if found else np.zeros(0, np.int64)


class Vocabulary:
    """Ranks of byte strings, merges through a cache, and the tokens' bytes."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = max(self.ranks.values()) + 1
        tokens: list[bytes | None] = [None] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.known = np.array([token is not None for token in tokens])
        lengths = np.fromiter((len(token or b"") for token in tokens), np.int64, size)
        self.places = np.concatenate([[0], np.cumsum(lengths)])
        self.blob = np.frombuffer(b"".join(token or b"" for token in tokens), dtype=np.uint8)
        self.cache: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.size = 0

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one slice: always the pair of lowest rank, the leftmost of equal ones."""
        ranks, n = self.ranks, len(piece)
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        if n <= SHORT_SLICE:
            return self._merged_short(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # by the start of each part

        def joined(at: int) -> int | None:
            middle = end[at]
            return ranks.get(piece[at : end[middle]]) if middle < n else None

        heap = [(rank, at) for at in range(n - 1) if (rank := joined(at)) is not None]
        heapq.heapify(heap)
        gone = bytearray(n + 1)
        while heap:
            rank, at = heapq.heappop(heap)
            if gone[at] or joined(at) != rank:
                continue
            middle = end[at]
            gone[middle], end[at] = 1, end[middle]
            if end[at] < n:
                before[end[at]] = at
            for changed in (before[at], at):
                if changed >= 0 and (fresh := joined(changed)) is not None:
                    heapq.heappush(heap, (fresh, changed))
        out, at = [], 0
        while at < n:
            out.append(ranks[piece[at : end[at]]])
            at = end[at]
        return tuple(out)

    def _merged_short(self, piece: bytes) -> tuple[int, ...]:
        get, none = self.ranks.get, len(self.known)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (low := min(pairs)) < none:
            at = pairs.index(low)
            parts[at] += parts.pop(at + 1)
            del pairs[at]
            if at < len(pairs):
                pairs[at] = get(parts[at] + parts[at + 1], none)
            if at:
                pairs[at - 1] = get(parts[at - 1] + parts[at], none)
        return tuple(map(self.ranks.__getitem__, parts))

    def learn(self, pieces: set[bytes]) -> None:
        """Bring the ids of slices into the cache of two halves: a full new half
        becomes the old one, and what the old one held unasked is forgotten."""
        missing = pieces.difference(self.cache)
        if len(self.cache) + len(missing) > CACHED or self.size > CACHED_BYTES:
            self.cache, self.old, self.size, missing = {}, self.cache, 0, pieces
        self.size += sum(map(len, missing))
        for piece in missing:
            self.cache[piece] = self.old.get(piece) or np.array(self.merged(piece), dtype=np.int32).tobytes()

    def encoded(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, the first id of each row)."""
        starts = slices(data, offsets)
        whole, cuts = data.tobytes(), [*starts.tolist(), len(data)]
        parts, counts = [], np.zeros(len(starts) + 1, dtype=np.int64)
        for at in range(0, len(starts), SLICES):
            pieces = [whole[a:b] for a, b in zip(cuts[at : at + SLICES], cuts[at + 1 : at + SLICES + 1])]
            self.learn(set(pieces))
            lists = list(map(self.cache.__getitem__, pieces))
            counts[at + 1 : at + 1 + len(lists)] = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
            parts += lists
        before = np.cumsum(counts)
        return np.frombuffer(b"".join(parts), dtype=np.int32), before[np.searchsorted(starts, offsets)]

    def token_ends(self, ids: np.ndarray) -> np.ndarray:
        """0 and the byte place where each id's token ends in the decoded bytes."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        return np.concatenate([[0], np.cumsum(self.places[ids + 1] - self.places[ids])])

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a list of ids, gathered from the tokens' bytes."""
        ends = self.token_ends(ids)
        place = np.arange(ends[-1]) + np.repeat(self.places[ids] - ends[:-1], np.diff(ends))
        return self.blob[place]


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """The worker's vocabulary; its cache serves all tasks that the worker runs."""
    return Vocabulary(path)


def encoded(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, ids and offsets (the byte place of each
    token in the text, and the text's length: one more than ids)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(ranks)
        for batch in sliced(batches, 1):
            data, offsets = text_bytes(batch.column(1))
            ids, first = own.encoded(data, offsets)
            ends = own.token_ends(ids)
            # Row i has the places of its tokens and one more, counted from its start.
            at = np.arange(len(ids) + batch.num_rows) - np.repeat(np.arange(batch.num_rows), np.diff(first) + 1)
            places = (ends[at] - np.repeat(ends[first[:-1]], np.diff(first) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))
            byte_at = pa.ListArray.from_arrays(pa.array((first + np.arange(len(first))).astype(np.int32)), pa.array(places))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, byte_at], ["id", "ids", "offsets"])

    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return narrow.mapInArrow(run, f"id {kind}, ids array<int>, offsets array<int>")


def decoded(tokens: DataFrame, ranks: str) -> DataFrame:
    """`tokens` (any columns, with ids) and decoded: the bytes of the ids."""
    place, names = tokens.columns.index("ids"), [*tokens.columns, "decoded"]
    plain = [f"c{i}" for i in range(len(names))]  # a name may hold any character

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(ranks)
        for batch in batches:
            count = pc.fill_null(pc.list_value_length(batch.column(place)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            part = (np.cumsum(count) - count) // PIECE
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                rows = batch.slice(a, b - a)
                ids = pc.fill_null(rows.column(place).flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                held = pc.fill_null(pc.list_value_length(rows.column(place)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = own.token_ends(ids)[np.concatenate([[0], np.cumsum(held)])]
                texts = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(own.decoded(ids))])
                yield pa.RecordBatch.from_arrays([*rows.columns, texts.cast(pa.binary())], plain)

    fields = ", ".join(f"{c} {f.dataType.simpleString()}" for c, f in zip(plain, tokens.schema.fields))
    return tokens.toDF(*plain[:-1]).mapInArrow(run, f"{fields}, {plain[-1]} binary").toDF(*names)
