"""Byte-level BPE encoding and decoding by longest matches and backtracking.

The bytes of a piece are read as Latin-1, one character a byte, so an
Aho-Corasick automaton over characters finds every vocabulary entry in it in one
pass. The encoder takes the longest entry at each position and goes back to
shorter ones until every adjacent pair is compatible: merging by rank would keep
exactly that border. Whether two entries are compatible does not depend on the
text, so it is memoised, and a position from which no compatible sequence leads
on is tried once. The result is the sequence that rank-order merging gives, in
time linear in the piece.

Defined results: a null text is the empty text, without ids; very long texts and
pieces are encoded whole; every row is encoded on its own, so repeated rows
give equal results; an empty table gives an empty result; other columns are kept
by ``encode`` unless they clash with its two columns, which then replace them.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from vaultspan.llm.scratch import unused

PIECE_CACHE = 300_000


def read_ranks(path: str) -> bytes:
    """The rank file; about a megabyte, a constant of the vocabulary."""
    with open(path, "rb") as file:
        return file.read()


class BytePairCodec:
    def __init__(self, ranks: bytes, pattern: str):
        self.bytes_of = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in ranks.splitlines() if line)}
        self.id_of = {token.decode("latin-1"): rank for rank, token in self.bytes_of.items()}
        self._split = regex.compile(pattern).findall
        self._automaton = ahocorasick.Automaton()
        for token, rank in self.id_of.items():
            self._automaton.add_word(token, rank)
        self._automaton.make_automaton()
        self._length = {rank: len(token) for rank, token in self.bytes_of.items()}
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._shorter: dict[int, int | None] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self._young: dict[str, bytes] = {}  # ids of pieces, in two generations
        self._old: dict[str, bytes] = {}

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two entries whose merge makes this one; None for an entry that merging never makes."""
        if token not in self._parts:
            sequence = [self.id_of[c] for c in self.bytes_of[token].decode("latin-1")]
            while len(sequence) > 2:
                merged = [self.id_of.get(self._text(a) + self._text(b), token) for a, b in zip(sequence, sequence[1:])]
                best = min(merged)
                if best >= token:
                    break
                at = merged.index(best)
                sequence[at : at + 2] = [best]
            self._parts[token] = tuple(sequence) if len(sequence) == 2 else None
        return self._parts[token]

    def _text(self, token: int) -> str:
        return self.bytes_of[token].decode("latin-1")

    def fits(self, left: int, right: int) -> bool:
        """Whether rank-order merging keeps the border between two adjacent entries.

        Both entries are taken apart in the reverse order of their merges. The
        entries at the border at each moment must not have had a merge of their own
        that comes before the merge that was just undone.
        """
        known = self._fits.get((left, right))
        if known is not None:
            return known
        a, b, undone = left, right, float("inf")
        verdict = all(self._length[t] == 1 or self.parts(t) is not None for t in (left, right))
        while verdict:
            joined = self.id_of.get(self._text(a) + self._text(b))
            # at equal rank the leftmost merge is the earlier one
            if joined is not None and joined < undone:
                verdict = False
                break
            made_a, made_b = self._length[a] > 1, self._length[b] > 1
            if not made_a and not made_b:
                break
            if made_a and (not made_b or a > b):
                halves, undone = self.parts(a), a
                if halves is None:
                    verdict = False
                    break
                a = halves[1]
            else:
                halves, undone = self.parts(b), b + 1
                if halves is None:
                    verdict = False
                    break
                b = halves[0]
        if len(self._fits) > 2_000_000:
            self._fits.clear()
        self._fits[(left, right)] = verdict
        return verdict

    def shorter(self, token: int) -> int | None:
        """The longest entry that is a proper beginning of this one."""
        if token not in self._shorter:
            text = self._text(token)
            self._shorter[token] = next(
                (self.id_of[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.id_of), None
            )
        return self._shorter[token]

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece, given as Latin-1 characters."""
        whole = self.id_of.get(piece)
        if whole is not None and (len(piece) == 1 or self.parts(whole) is not None):
            return [whole]
        size = len(piece)
        longest = [0] * size
        length, known, shorter = self._length, self._fits, self._shorter
        for end, token in self._automaton.iter(piece):
            longest[end - length[token] + 1] = token  # later ends are longer
        ids: list[int] = []
        open_at = bytearray(b"\x01" * (size + 1))
        at, token, last = 0, longest[0], -1
        while at < size:
            while True:
                end = at + length[token]
                if open_at[end]:
                    if last < 0:
                        good = length[token] == 1 or self.parts(token) is not None
                    else:
                        good = known.get((last, token))
                        if good is None:
                            good = self.fits(last, token)
                    if good:
                        ids.append(token)
                        at, last = end, token
                        token = longest[at] if at < size else -1
                        break
                token = shorter[token] if token in shorter else self.shorter(token)
                if token is None:
                    open_at[at] = 0
                    token = ids.pop()
                    last = ids[-1] if ids else -1
                    at -= length[token]
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        pieces = self._split(text)
        found = list(map(self._young.get, pieces))
        if None in found:
            young, old = self._young, self._old
            for k, piece in enumerate(pieces):
                if found[k] is None:
                    ids = young.get(piece) or old.get(piece)
                    if ids is None:
                        ids = array("I", self.encode_piece(piece.encode("utf-8").decode("latin-1"))).tobytes()
                    found[k] = ids
                    if len(piece) <= 64:
                        young[piece] = ids
            if len(young) >= PIECE_CACHE:
                self._young, self._old = {}, young
        return b"".join(found)

    def forget(self) -> None:
        """Drop what was learned from texts; the vocabulary and its entries' parts stay."""
        self._fits, self._young, self._old = {}, {}, {}

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, array("I", ids)))


_codecs: dict[tuple[int, str], BytePairCodec] = {}


def codec(ranks: bytes, pattern: str) -> BytePairCodec:
    """One codec per vocabulary and Python worker."""
    key = (hash(ranks), pattern)
    if key not in _codecs:
        _codecs[key] = BytePairCodec(ranks, pattern)
    return _codecs[key]


def _mapped(spark: SparkSession, ranks: bytes, pattern: str, column: int, name: str, kind: pa.DataType, work: Callable):
    """Replace one column of every batch; the vocabulary is broadcast, its size is fixed."""
    shared = spark.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value, pattern)
        try:
            for batch in batches:
                # a few texts at a time, so that the ids of a batch of long texts need not be held at once
                for row in range(0, batch.num_rows, 256):
                    part = batch.slice(row, 256)
                    rest = [part.column(i) for i in range(part.num_columns) if i != column]
                    names = [part.schema.names[i] for i in range(part.num_columns) if i != column]
                    new = work(own, part.column(column))
                    yield pa.record_batch(rest + [pa.array(x, t) for x, t in zip(new, kind)], names=names + list(name))
        finally:
            own.forget()  # a worker outlives its task and would hold this through every later stage

    return run


def encode(docs: DataFrame, path: str, pattern: str, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """Add ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens`` to the documents."""
    kept = [c for c in docs.columns if c not in (ids_column, "n_tokens")]
    name = unused(docs.columns, "_text")
    rows = docs.select([docs[c] for c in kept] + [docs[text_column].cast("string").alias(name)])

    def work(own: BytePairCodec, texts: pa.Array):
        ids = [own.encode(t) if t else b"" for t in texts.to_pylist()]
        return ids, [len(i) // 4 for i in ids]

    schema = rows.drop(name).schema.add(ids_column, "binary").add("n_tokens", "long")
    mapped = _mapped(docs.sparkSession, read_ranks(path), pattern, len(kept), (ids_column, "n_tokens"), (pa.binary(), pa.int64()), work)
    return rows.mapInArrow(mapped, schema)


def decode(rows: DataFrame, path: str, pattern: str, ids_column: str = "ids", bytes_column: str = "decoded") -> DataFrame:
    """Replace ``ids`` by the bytes they stand for; null ids give no bytes."""
    kept = [c for c in rows.columns if c not in (ids_column, bytes_column)]
    chosen = rows.select([rows[c] for c in kept] + [rows[ids_column]])
    schema = chosen.drop(ids_column).schema.add(bytes_column, "binary")
    mapped = _mapped(
        rows.sparkSession, read_ranks(path), pattern, len(kept), (bytes_column,), (pa.binary(),),
        lambda own, ids: ([own.decode(i) if i else b"" for i in ids.to_pylist()],),
    )
    return chosen.mapInArrow(mapped, schema)


def digest(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256 and decoded_sha256, encoded and decoded in one pass."""
    rows = docs.select(docs[id_column].cast("long").alias(id_column), docs[text_column].cast("string").alias("_text"))

    def work(own: BytePairCodec, texts: pa.Array):
        counts, of_ids, of_bytes = [], [], []
        for text in texts.to_pylist():
            ids = own.encode(text) if text else b""
            counts.append(len(ids) // 4)
            of_ids.append(hashlib.sha256(ids).hexdigest())
            of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
        return counts, of_ids, of_bytes

    mapped = _mapped(
        docs.sparkSession, read_ranks(path), pattern, 1, ("n_tokens", "ids_sha256", "decoded_sha256"), (pa.int64(), pa.string(), pa.string()), work
    )
    return rows.mapInArrow(mapped, f"{id_column} long, n_tokens long, ids_sha256 string, decoded_sha256 string")
