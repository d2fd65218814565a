"""Fill-in-the-middle transformation by piece tables.

A document is a table of descriptors (buffer, start, end) over two immutable
buffers, the UTF-8 text and the sentinels; no text is copied until it is
written out. Cutting splits a descriptor at a byte, an arrangement permutes the
descriptors and sets sentinels between them, the inverse permutation restores
the order, and hashes and output stream the descriptors.

Units are `[A-Za-z]+|[^A-Za-z]`: a run of ASCII letters or one other code
point. Their starts are found on the bytes of whole Arrow columns; two of the
unit boundaries, chosen by a hash of the id, cut prefix, middle and suffix.

    plain  text
    psm    <P> prefix <S> suffix <M> middle
    spm    <S> suffix <P> prefix <M> middle

The text is rebuilt from output and form alone: it holds no sentinel, and no
sentinel can arise where a piece meets one, so the first one found is the cut.

Defined results: a null text is an empty one; empty texts and texts that hold a
sentinel stay plain; a null id hashes like an empty one; rows that share an id
share their hashes, not their cuts; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import sliced, text_bytes

P, S, M = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 1
#: Percent of the documents that are cut, and of those the percent that is spm.
CUT, SUFFIX_FIRST = 90, 20

TEXT, MARKS = 0, 1
_MARKS = P + S + M
_MARK = {mark: (MARKS, _MARKS.index(mark), _MARKS.index(mark) + len(mark)) for mark in (P, S, M)}
#: Order of the descriptors (prefix, middle, suffix) in the output, and the sentinel before each.
ARRANGED = {PLAIN: ((0, None),), PSM: ((0, P), (2, S), (1, M)), SPM: ((2, S), (0, P), (1, M))}

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True

Descriptor = tuple[int, int, int]


@dataclass(frozen=True)
class PieceTable:
    """Descriptors over a text and the sentinels."""

    text: memoryview
    pieces: tuple[Descriptor, ...]

    @classmethod
    def whole(cls, text: bytes | memoryview) -> "PieceTable":
        return cls(memoryview(text), ((TEXT, 0, len(text)),))

    def cut(self, *places: int) -> "PieceTable":
        """Split the descriptors of the text at ascending byte places, empty pieces included."""
        pieces = list(self.pieces)
        for place in places:
            at = max(i for i, (buffer, start, _) in enumerate(pieces) if buffer == TEXT and start <= place)
            buffer, start, end = pieces[at]
            pieces[at : at + 1] = [(buffer, start, place), (buffer, place, end)]
        return PieceTable(self.text, tuple(pieces))

    def arranged(self, form: str) -> "PieceTable":
        """The pieces in a form's order, each behind its sentinel."""
        out: list[Descriptor] = []
        for piece, mark in ARRANGED[form]:
            out += [_MARK[mark], self.pieces[piece]] if mark else [self.pieces[piece]]
        return PieceTable(self.text, tuple(out))

    def restored(self, form: str) -> "PieceTable":
        """The inverse permutation of `arranged`, without the sentinels."""
        own = [piece for piece in self.pieces if piece[0] == TEXT]
        order = [piece for piece, _ in ARRANGED[form]]
        return PieceTable(self.text, tuple(own[order.index(i)] for i in range(len(order))))

    @classmethod
    def parsed(cls, output: bytes, form: str) -> "PieceTable":
        """The table of an arranged output, its sentinels found in the output itself."""
        pieces, at, marks = [], 0, [mark for _, mark in ARRANGED[form] if mark]
        for mark in marks:
            found = output.index(mark, at)
            pieces += [(TEXT, at, found)] if at else []
            pieces.append(_MARK[mark])
            at = found + len(mark)
        return cls(memoryview(output), (*pieces, (TEXT, at, len(output))))

    def stream(self) -> Iterator[memoryview]:
        buffers = (self.text, memoryview(_MARKS))
        return (buffers[buffer][start:end] for buffer, start, end in self.pieces)

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()

    def written(self) -> bytes:
        return b"".join(self.stream())


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, first): the byte places where units start, and the first unit of each row."""
    letter = _LETTER[data]
    inside = (data & 0xC0) == 0x80
    inside[1:] |= letter[1:] & letter[:-1]
    rows = offsets[:-1][np.diff(offsets) > 0]
    inside[rows] = False
    starts = np.flatnonzero(~inside)
    return starts, np.searchsorted(starts, offsets)


def draws(id_: object, seed: int = SEED) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))  # type: ignore[return-value]


def _characters(data: np.ndarray) -> int:
    return len(data) - int(np.count_nonzero((data & 0xC0) == 0x80))


_COLUMNS = "n long, form string, prefix_chars long, middle_chars long, pieces array<struct<buffer:int,start:long,end:long>>, output string, output_sha256 string"


def transformed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, cut: int = CUT, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """One row per row of `docs`: id, n (units), form, prefix_chars and
    middle_chars (code points; null if plain), pieces (descriptors of the
    output: buffer 0 is the text, 1 the sentinels `<P><S><M>`; byte places),
    output and output_sha256 (streamed from the descriptors)."""
    kind = docs.schema[id_col].dataType
    rows = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    names = ["n", "form", "prefix_chars", "middle_chars", "pieces", "output", "output_sha256"]

    def one(id_: object, data: np.ndarray, starts: np.ndarray) -> tuple:
        text, n = data.tobytes(), len(starts)
        h1, h2, h3, h4 = draws(id_, seed)
        if not text or any(mark in text for mark in (P, S, M)) or h3 % 100 >= cut:
            table = PieceTable.whole(text)
            return n, PLAIN, None, None, table.pieces, table.written(), table.sha256()
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = (int(starts[unit]) if unit < n else len(text) for unit in (low, high))
        form = SPM if h4 % 100 < suffix_first else PSM
        table = PieceTable.whole(text).cut(a, b).arranged(form)
        return n, form, _characters(data[:a]), _characters(data[a:b]), table.pieces, table.written(), table.sha256()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), rows, pa.binary(), pa.string()]
        for batch in sliced(batches, 1):
            data, offsets = text_bytes(batch.column(1))
            starts, first = unit_starts(data, offsets)
            out = [
                one(id_, data[a:b], starts[i:j] - a)
                for id_, a, b, i, j in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), first[:-1].tolist(), first[1:].tolist())
            ]
            columns = [pa.array(values, type) for values, type in zip(zip(*out), types)]
            columns[5] = columns[5].cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *names])

    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return narrow.mapInArrow(run, f"id {kind.simpleString()}, {_COLUMNS}")


def restored(outputs: DataFrame) -> DataFrame:
    """`outputs` (any columns, with output and form) and restored, restored_sha256:
    the text rebuilt from output and form alone. A null output or form gives nulls."""
    place, form_at = outputs.columns.index("output"), outputs.columns.index("form")
    names = [*outputs.columns, "restored", "restored_sha256"]
    plain = [f"c{i}" for i in range(len(names))]  # a name may hold any character

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, place):
            texts, digests = [], []
            for output, form in zip(batch.column(place).cast(pa.large_binary()).to_pylist(), batch.column(form_at).to_pylist()):
                table = None if output is None or form is None else PieceTable.parsed(output, form).restored(form)
                texts.append(table and table.written())
                digests.append(table and table.sha256())
            columns = [*batch.columns, pa.array(texts, pa.binary()).cast(pa.string()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, plain)

    fields = ", ".join(f"{c} {f.dataType.simpleString()}" for c, f in zip(plain, outputs.schema.fields))
    return outputs.toDF(*plain[:-2]).mapInArrow(run, f"{fields}, {plain[-2]} string, {plain[-1]} string").toDF(*names)
