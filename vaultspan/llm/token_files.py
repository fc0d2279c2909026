"""Token ids in Arrow files of equal-length sequences.

Documents are tokenised, each gets an end id, and the ids are laid one after
another into sequences of one length: fixed-size-list columns ``ids`` and ``mask``
(false on the padding that ends a file) in record batches of a fixed number of
sequences, in Arrow's file format. So sequence i of a file is batch i // n, row
i % n, and a reader maps it without copying. Files follow one another in the order
of the documents; an index tells file, first id and number of ids of each.

A task writes files under names of its own attempt and reports them with its index
rows. The index is stored before it is used, so only files of successful attempts
are ever read and a task that is run again does no harm.

Tokenising caches the ids of words: what stands between spaces, also cut between an
ASCII letter and full stop, comma, colon, semicolon, exclamation or question mark. That is
exact for tokenizers that drop white space, split at it and keep letters apart from
punctuation: normalisation never joins characters across such a border, and no pre-token
crosses one. Words are told apart by 64-bit hashes, without letter case of ASCII letters
where the tokenizer lower-cases itself.

Defined results: a null, empty or blank text has the end id alone; very long texts
run over as many sequences as they need; repeated rows are stored as often as they
come, ordered by id and then by text hash; null ids come first; an empty table gives
no files and an empty result; other columns are never read.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vaultspan.llm.scratch import Scratch
from vaultspan.llm.words import Words, chunks

WORD_CACHE = 300_000
_SEPARATOR = b"\x01"
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_POINT = np.zeros(256, dtype=bool)
_POINT[list(b".,;:!?")] = True
FILE_IDS = 32_000_000  # a file ends with the document that brings it past so many ids

INDEX = "file string, part int, turn int, id long, first long, n_tokens long"


def _opened(folder: str) -> tuple[pa.fs.FileSystem, str]:
    uri = f"file://{folder.removeprefix('file:')}" if folder.startswith("file:/") and not folder.startswith("file://") else folder
    if uri.startswith("/"):
        return pa.fs.LocalFileSystem(), uri
    return pa.fs.FileSystem.from_uri(uri)


class WordTokenizer:
    """Ids of a chunk of texts by the tokenizers library, with the ids of words cached in two generations."""

    def __init__(self, definition: str):
        self._tokenizer = Tokenizer.from_str(definition)
        self.kind = np.uint16 if self._tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self._code = "H" if self.kind is np.uint16 else "I"
        self._lowers = '"Lowercase"' in definition
        alone = self._ids([_SEPARATOR])[0]
        self._separator = alone[0] if len(alone) == 1 else None
        # normalisation and pre-tokenisation leave a lower-case ASCII word as it is
        self._direct = self._lowers and r"[\\p{L}]+" in definition and '"ByteLevel"' in definition
        self._young: dict[int, bytes] = {}
        self._old: dict[int, bytes] = {}

    def _ids(self, texts: list[bytes]) -> list[np.ndarray]:
        encoded = self._tokenizer.encode_batch_fast([t.decode("utf-8") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind) for e in encoded]

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word. Plain words go to the library's model, others through the whole tokenizer,
        as one text with a separator of its own id between them."""
        out: list[bytes] = [b""] * len(words)
        rest = range(len(words))
        if self._direct:
            tokenize, rest = self._tokenizer.model.tokenize, []
            for k, word in enumerate(words):
                if word.isalpha():
                    out[k] = array(self._code, [t.id for t in tokenize(word.lower().decode())]).tobytes()
                else:
                    rest.append(k)
        odd = [k for k in rest if self._separator is None or _SEPARATOR in words[k]]
        for k in odd:
            out[k] = self._ids([words[k]])[0].tobytes()
        rest = [k for k in rest if not out[k]] if odd else rest
        for at in range(0, len(rest), 20_000):
            some = rest[at : at + 20_000]
            ids = self._ids([(b" " + _SEPARATOR + b" ").join([words[k] for k in some])])[0]
            raw, wide = ids.tobytes(), ids.itemsize
            cuts = np.flatnonzero(ids == self._separator).tolist()
            for k, first, stop in zip(some, [0] + [c + 1 for c in cuts], cuts + [len(ids)]):
                out[k] = raw[first * wide : stop * wide]
        return out

    def __call__(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk's texts one after another, and how many each text has."""
        before = np.concatenate([[0], data[:-1]])
        words = Words(offsets, data, fold=self._lowers, breaks=_POINT[data] & _LETTER[before])
        values, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        values = values.tolist()
        if len(self._young) > WORD_CACHE:
            self._old, self._young = self._young, {}
        young, old = self._young, self._old
        absent = [k for k, v in enumerate(values) if v not in young]
        for k in absent:
            if values[k] in old:
                young[values[k]] = old[values[k]]
        absent = [k for k in absent if values[k] not in young]
        if absent:
            raw = data.tobytes()
            spans = zip(words.start[first[absent]].tolist(), words.end[first[absent]].tolist())
            young.update(zip([values[k] for k in absent], self._encoded([raw[a:b] for a, b in spans])))
        parts = [young[v] for v in values]
        for k in absent:
            if len(young[values[k]]) > 128:  # long words seldom come again
                del young[values[k]]
        pool = np.frombuffer(b"".join(parts), dtype=self.kind)
        size = np.array([len(p) for p in parts], dtype=np.int64) // np.dtype(self.kind).itemsize
        from_ = np.cumsum(size) - size
        lengths = size[which]
        to = np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        ids = pool[np.repeat(from_[which] - to, lengths) + np.arange(total)]
        return ids, np.bincount(words.document, lengths, len(offsets) - 1).astype(np.int64)


_tokenizers: dict[int, WordTokenizer] = {}


def word_tokenizer(definition: str) -> WordTokenizer:
    key = hash(definition)
    if key not in _tokenizers:
        _tokenizers[key] = WordTokenizer(definition)
    return _tokenizers[key]


class SequenceWriter:
    """One file: ids go in as they come, whole batches of sequences go out."""

    def __init__(self, target, kind: np.dtype, length: int, per_batch: int):
        self._length, self._per_batch, self._kind = length, per_batch, np.dtype(kind)
        self._schema = pa.schema(
            [("ids", pa.list_(pa.from_numpy_dtype(self._kind), length)), ("mask", pa.list_(pa.bool_(), length))]
        )
        self._file = pa.ipc.new_file(target, self._schema)
        self._waiting: list[bytes] = []
        self._bytes = 0
        self.count = 0

    def add(self, ids: bytes) -> None:
        self._waiting.append(ids)
        self._bytes += len(ids)
        self.count += len(ids) // self._kind.itemsize
        whole = self._length * self._per_batch * self._kind.itemsize
        if self._bytes >= whole:
            data = b"".join(self._waiting)
            stop = len(data) // whole * whole
            for at in range(0, stop, whole):
                self._write(np.frombuffer(data, self._kind, self._length * self._per_batch, at), self._length * self._per_batch)
            self._waiting, self._bytes = [data[stop:]], len(data) - stop

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        self._file.write_batch(
            pa.record_batch(
                [
                    pa.FixedSizeListArray.from_arrays(pa.array(ids), self._length),
                    pa.FixedSizeListArray.from_arrays(pa.array(mask), self._length),
                ],
                schema=self._schema,
            )
        )

    def close(self) -> None:
        rest = np.frombuffer(b"".join(self._waiting), self._kind)
        if len(rest):
            padded = np.zeros(-(-len(rest) // self._length) * self._length, dtype=self._kind)
            padded[: len(rest)] = rest
            self._write(padded, len(rest))
        self._file.close()


class SequenceFile:
    """Random access to a file's sequences and to spans of its ids."""

    def __init__(self, place: str):
        system, path = _opened(place)
        source = pa.memory_map(path) if isinstance(system, pa.fs.LocalFileSystem) else system.open_input_file(path)
        self._reader = pa.ipc.open_file(source)
        self._length = self._reader.schema.field("ids").type.list_size
        self._per_batch = self._reader.get_batch(0).num_rows if self._reader.num_record_batches else 1
        self._at: tuple[int, pa.RecordBatch] | None = None

    def _batch(self, number: int) -> pa.RecordBatch:
        if self._at is None or self._at[0] != number:
            self._at = (number, self._reader.get_batch(number))
        return self._at[1]

    def sequence(self, number: int) -> tuple[pa.Array, pa.Array]:
        """Ids and mask of one sequence, views of the mapped file."""
        batch, row = self._batch(number // self._per_batch), number % self._per_batch
        cut = lambda c: c.flatten().slice(row * self._length, self._length)
        return cut(batch.column(0)), cut(batch.column(1))

    def span(self, first: int, count: int) -> np.ndarray:
        """``count`` ids from ``first`` on; all of them must be real ones."""
        size, parts = self._length * self._per_batch, []
        while count > 0:
            batch, at = self._batch(first // size), first % size
            ids = batch.column(0).flatten().slice(at, count)
            if not pa.compute.all(batch.column(1).flatten().slice(at, count)).as_py():
                raise ValueError("the index points into padding")
            parts.append(ids.to_numpy())
            first, count = first + len(ids), count - len(ids)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def write_token_files(
    scratch: Scratch,
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    length: int = 2048,
    per_batch: int = 256,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Write the files below the scratch folder; return the stored index of the documents."""
    with open(tokenizer, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())  # a constant of the vocabulary
    folder = f"{scratch.folder}/tokens"
    ordered = (
        docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(F.asc_nulls_first("id"), F.asc("tie"))
        .sortWithinPartitions(F.asc_nulls_first("id"), F.asc("tie"))
        .withColumn("part", F.spark_partition_id())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokenizer(definition.value)
        end = np.array([end_id], dtype=encode.kind).tobytes()
        system, base = _opened(folder)
        system.create_dir(base, recursive=True)
        writer = sink = name = None
        turn = -1
        for batch in batches:
            for row, offsets, data in chunks(batch.column(1), 4 << 20):
                ids, counts = encode(offsets, data)
                stops, rows = np.cumsum(counts).tolist(), []
                keys, parts = (batch.column(c).slice(row, len(counts)).to_pylist() for c in (0, 2))
                for key, part, count, stop in zip(keys, parts, counts.tolist(), stops):
                    if writer is None or writer.count >= FILE_IDS:
                        if writer is not None:
                            writer.close()
                            sink.close()
                        turn += 1
                        name = f"{part:06d}-{turn:04d}-{uuid.uuid4().hex}.arrow"
                        sink = system.open_output_stream(f"{base}/{name}")
                        writer = SequenceWriter(sink, encode.kind, length, per_batch)
                    rows.append((f"{folder}/{name}", part, turn, key, writer.count, count + 1))
                    writer.add(ids[stop - count : stop].tobytes() + end)
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["file", "part", "turn", "id", "first", "n_tokens"],
                )
        if writer is not None:
            writer.close()
            sink.close()

    return scratch.store(ordered.select("id", "text", "part").mapInArrow(run, INDEX), "index")


def read_token_files(index: DataFrame) -> DataFrame:
    """Read every document back: id, start (over all files), n_tokens and ids_crc32."""
    files = index.groupBy("part", "turn").agg(F.sum("n_tokens").alias("ids"))
    earlier = Window.orderBy("part", "turn").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "turn", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before"))  # a row per file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = opened = None
        for batch in batches:
            sums = []
            for name, first, count in zip(*[batch.column(c).to_pylist() for c in ("file", "first", "n_tokens")]):
                if name != place:
                    place, opened = name, SequenceFile(name)
                sums.append(zlib.crc32(opened.span(first, count).astype("<u4").tobytes()))
            yield pa.record_batch(
                [batch.column(c) for c in ("id", "part", "turn", "first", "n_tokens")] + [pa.array(sums, pa.int64())],
                names=["id", "part", "turn", "first", "n_tokens", "ids_crc32"],
            )

    found = index.mapInArrow(run, "id long, part int, turn int, first long, n_tokens long, ids_crc32 long")
    return found.join(starts, ["part", "turn"]).select(
        "id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
