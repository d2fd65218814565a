"""Token-ID output: flat unsigned 16- or 32-bit files with 64-bit document offsets.

Layout of one output folder, in ascending id order over the shards:

    shard-00000.bin   token ids, little-endian, of one range of documents
    shard-00000.idx   int64 offsets into the shard: documents + 1 values
    shard-00000.ids   int64 document ids

The documents are range-partitioned on the id and each task streams its shard
to attempt-named files, which are renamed when whole: a repeated or lost
attempt leaves no half shard. Shard bases are prefix sums of shard totals, so
a document's place in the whole corpus is base + offset. Readers map the files
into memory.

A text is cut at ASCII white space, which the tokenizer drops, and each
distinct chunk is encoded once per worker; the ids are those of the whole text.
Where the tokenizer's own description says that it folds case and encodes runs
of letters, digits and other characters apart, a chunk of ASCII and Latin-1
letters is cut into these runs, and only runs not seen before go to its model.

Defined results: null text encodes like an empty one, to the end id alone;
rows that share an id keep their rows in text order (null first); a null id
sorts first and is stored as the smallest int64; extra columns are ignored; an
empty table writes no shard and gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark import TaskContext

from ..sources.scratch import materialize
from .text import sliced

END = 1
NO_ID = -(1 << 63)
#: Distinct chunks that one worker remembers: this many new ones, and as many from before.
CACHED = 400_000
#: First code points of a text that divide the rows of one id over shards.
DIVIDING = 64
_MARK = "<|endoftext|>"
#: How a tokenizer folds and cuts whose runs are encoded apart from each other, and the same cuts for folded `_PLAIN` text.
_FOLDS = ["NFC", "Replace", "Lowercase"]
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PLAIN_CUTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class _Remembered(dict):
    """What `encode` gives for each key. When `most` keys are there they become
    the old ones, and what was old and nobody asked for again is forgotten."""

    def __init__(self, encode, most: int) -> None:
        self.encode, self.most, self.old = encode, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        found = self.old.pop(key, None)
        self[key] = found = self.encode(key) if found is None else found
        return found


class Encoder:
    """Ids of whole texts as little-endian bytes, through a cache of chunks.

    The cache has two halves. When the new half is full it becomes the old
    one, and what the old one held and nobody asked for again is forgotten.
    Where the tokenizer encodes runs apart (`_cuts_apart`) there is such a
    cache of runs too, half as large, from which chunks are put together.
    """

    def __init__(self, path: str, dtype: str, cached: int | None = None) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = dtype
        self.cached = cached or CACHED
        self.mark = self.tokenizer.token_to_id(_MARK)
        self.cache: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.chunks = self.runs = None
        if self._cuts_apart():
            self.model = self.tokenizer.model
            self.letters = str.maketrans({c: self._byte_level(c) for c in "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"})
            self.chunks = _Remembered(self._chunk, self.cached)
            self.runs = _Remembered(self._run, max(1, self.cached // 2))

    def _cuts_apart(self) -> bool:
        """Whether the tokenizer folds and cuts as `_PLAIN_CUTS` does on folded text and then encodes each run alone."""
        own = json.loads(self.tokenizer.to_str())
        steps = (own["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        folds = [n["type"] for n in (own["normalizer"] or {}).get("normalizers") or []]
        cut = steps[0].get("pattern") == {"Regex": _CUTS} and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
        rest = [(step["type"], step.get("add_prefix_space"), step.get("use_regex")) for step in steps[1:]]
        special = all(t["content"].startswith("<|") and not t["normalized"] for t in own["added_tokens"])
        return bool(own["model"]["type"] == "BPE" and not own["model"].get("dropout") and special and cut and folds == _FOLDS and rest == [("ByteLevel", False, False)])

    def _byte_level(self, text: str) -> str:
        """How the tokenizer's model sees a run."""
        return "".join(piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))

    def _run(self, run: str) -> bytes:
        return np.array([token.id for token in self.model.tokenize(run.translate(self.letters))], dtype=self.dtype).tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if b"<|" in chunk or not _PLAIN.fullmatch(text):
            return self._ids(text).tobytes()
        return b"".join(map(self.runs.__getitem__, _PLAIN_CUTS.findall(text.lower())))

    def _ids(self, text: str) -> np.ndarray:
        encoded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(encoded.ids, dtype=self.dtype)

    def _learn(self, chunks: list[bytes]) -> None:
        plain = [c for c in chunks if b"<|" not in c] if self.mark is not None else []
        for at in range(0, len(plain), 1000):
            part = plain[at : at + 1000]
            ids = self._ids(_MARK.join(c.decode() for c in part))
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) != len(part) - 1:
                raise ValueError("the tokenizer did not keep the chunks apart")
            for chunk, a, b in zip(part, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]):
                self.cache[chunk] = ids[a:b].tobytes()
        for chunk in set(chunks).difference(plain):
            self.cache[chunk] = self._ids(chunk.decode()).tobytes()

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([(text or "").encode()])[0]

    def encode_all(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text. What the cache lacks of all of them is encoded in one go."""
        if self.chunks is not None:
            # Folded first, so that fewer chunks differ; but "<|ENDOFTEXT|>" is no special token.
            folded = (text if b"<|" in text else text.lower() for text in (text or b"" for text in texts))
            return [b"".join(map(self.chunks.__getitem__, text.split())) for text in folded]
        split = [(text or b"").split() for text in texts]
        known = set().union(*split)
        missing = known.difference(self.cache)
        if missing:
            if len(self.cache) + len(missing) > self.cached:
                self.cache, self.old, missing = {}, self.cache, known
            for chunk in [c for c in missing if c in self.old]:
                self.cache[chunk] = self.old.pop(chunk)
            self._learn(list(missing.difference(self.cache)))
        return [b"".join(map(self.cache.__getitem__, chunks)) for chunks in split]


_ENCODERS: dict[tuple[str, str, int | None], Encoder] = {}


def encoder_of(path: str, dtype: str, cached: int | None = None) -> Encoder:
    """The worker's encoder; its cache serves all tasks that the worker runs."""
    if (path, dtype, cached) not in _ENCODERS:
        _ENCODERS[path, dtype, cached] = Encoder(path, dtype, cached)
    return _ENCODERS[path, dtype, cached]


def _store(uri: str):
    """(file system, path) that a task reads and writes for `uri`."""
    from pyarrow import fs

    if not urlparse(uri).scheme:
        uri = f"file://{os.path.abspath(uri)}"
    return fs.FileSystem.from_uri(uri)


def _written(folder: str, path: str, dtype: str, end: int, cached: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tail = encoder_of(path, dtype, cached), np.array([end], dtype=dtype).tobytes()
        width = len(tail)
        shard = TaskContext.get().partitionId()
        store, root = _store(folder)
        attempt, names, files = uuid.uuid4().hex, {}, {}
        docs = tokens = 0
        low = high = None
        for batch in sliced(batches, 1):
            if not files:
                for kind in ("bin", "idx", "ids"):
                    names[kind] = f"{root}/shard-{shard:05d}.{kind}"
                    files[kind] = store.open_output_stream(f"{names[kind]}.{attempt}")
                files["idx"].write(np.zeros(1, "<i8").tobytes())
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype("<i8")
            blobs = encoder.encode_all(batch.column(1).cast(pa.binary()).to_pylist())
            sizes = np.fromiter(map(len, blobs), "<i8", len(blobs)) // width + 1
            files["bin"].write(tail.join([*blobs, b""]))
            files["ids"].write(ids.tobytes())
            files["idx"].write((np.cumsum(sizes) + tokens).astype("<i8").tobytes())
            docs, tokens = docs + len(ids), tokens + int(sizes.sum())
            low, high = int(ids[0]) if low is None else low, int(ids[-1])
        for kind, file in files.items():
            file.close()
            store.move(f"{names[kind]}.{attempt}", names[kind])
        if files:
            row = [[shard], [docs], [tokens], [low], [high]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in row], ["shard", "docs", "tokens", "low", "high"])

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", dtype: str = "<u2", end: int = END, cached: int | None = None) -> DataFrame:
    """Write the token files of `docs` below `folder` and return the manifest:
    (shard, docs, tokens, low, high, base), base being the tokens of all shards
    before. `dtype` is "<u2" (every id below 65,536) or "<u4". `cached` chunks are
    remembered by a worker instead of `CACHED`: less memory, more encoding."""
    spark = docs.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    # The start of the text divides the rows of one hot id, or of none, without changing the order.
    sized = narrow.repartitionByRange(order[0], F.substring("text", 1, DIVIDING).asc_nulls_first()).sortWithinPartitions(*order)
    shards = materialize(sized.mapInArrow(_written(folder, tokenizer, dtype, end, cached), "shard long, docs long, tokens long, low long, high long"), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return shards.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))


class TokenShard:
    """One shard, mapped into memory."""

    def __init__(self, folder: str, shard: int, dtype: str = "<u2") -> None:
        store, root = _store(folder)
        parts = {}
        for kind, own in (("bin", dtype), ("idx", "<i8"), ("ids", "<i8")):
            name = f"{root}/shard-{shard:05d}.{kind}"
            if urlparse(folder).scheme in ("", "file"):
                parts[kind] = np.memmap(name, dtype=own, mode="r")
            else:
                parts[kind] = np.frombuffer(store.open_input_stream(name).readall(), dtype=own)
        self.tokens, self.offsets, self.ids = parts["bin"], parts["idx"], parts["ids"]

    def __len__(self) -> int:
        return len(self.ids)

    def __getitem__(self, row: int) -> np.ndarray:
        return self.tokens[self.offsets[row] : self.offsets[row + 1]]


def _read(folder: str, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist()):
                part = TokenShard(folder, shard, dtype)
                for at in range(0, len(part), 1_000):
                    stop = min(at + 1_000, len(part))
                    ids = pa.array(np.array(part.ids[at:stop]), pa.int64())
                    offsets = np.array(part.offsets[at : stop + 1])
                    wide = memoryview(np.asarray(part.tokens[offsets[0] : offsets[-1]]).astype("<u4")).cast("B")
                    cuts = ((offsets - offsets[0]) * 4).tolist()
                    crc = [zlib.crc32(wide[a:b]) for a, b in zip(cuts, cuts[1:])]
                    columns = [ids, pa.array(offsets[:-1] + base), pa.array(np.diff(offsets)), pa.array(crc, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "start", "n_tokens", "ids_crc32"])

    return run


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame, dtype: str = "<u2") -> DataFrame:
    """One row per document of the files: id, start (ids of all documents
    before it), n_tokens (with the end id) and ids_crc32 (CRC-32 of its ids as
    little-endian unsigned 32-bit integers). Each shard is a task of its own."""
    last = manifest.agg(F.max("shard")).first()[0]
    shards = manifest.select("shard", "base").repartitionById(1 + (last or 0), F.col("shard").cast("int"))
    found = shards.mapInArrow(_read(folder, dtype), "id long, start long, n_tokens long, ids_crc32 long")
    return found.withColumn("id", F.when(F.col("id") != NO_ID, F.col("id")))
