"""Removal of long repeated byte strings by column-wise suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.
Equal strings are found as a collection of texts is suffix-sorted: column by column,
one symbol per text each round, keeping the order of the texts by what follows and the
common prefixes of neighbours (after Bauer, Cox, Rosone and Sciortino; Louza et al.).

* Every string of ``length`` bytes has an anchor: the leftmost place in it with the
  smallest hash of 24 bytes. The choice depends on the string alone, so equal strings
  have equal anchors at equal distances. A run of neighbouring starts with a common anchor
  place is one text of the collection, cut from its document; it ends ``length`` bytes
  after its last start. Only texts whose anchor occurs more than once go on.
* Texts of one anchor form a collection, aligned at the anchor; a task sorts many small
  collections together. Each round puts one symbol before every text and the order becomes
  that of (symbol, former order): the column, read in the former order, is what the round
  adds to the collection's Burrows-Wheeler transform. A neighbour's common prefix becomes one
  more than the least common prefix between the two before. As texts are aligned, equal
  strings always enter in the same round, so a round is not merged with earlier ones. Where
  neighbours have ``length`` bytes in common, the strings that start in this column repeat.
* The rounds read the texts from sequential files: the shuffle's, sorted by anchor and
  spilled. A task holds a bounded number of texts.

Equal texts are counted before they meet (a passage that a third of all documents holds
whole is one text). A collection with very many different texts, as at the borders of such a
passage, is not sorted in one task: its strings are hashed to 128 bits one by one and counted
by an aggregation that combines on the map side.

Strings are judged on the input, not on what is left, and never cross documents.

Defined results: a null text is empty; texts shorter than ``length`` bytes lose nothing;
repeated rows repeat each other's strings; rows with equal id and text have one result;
null ids are allowed; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultspan.llm.scratch import Scratch
from vaultspan.llm.words import U64, chunks, mix

LENGTH = 200
BLOCK_BYTES = 1 << 20
ANCHOR = 24
SORTED_TEXTS = 20_000  # texts that a task sorts at a time
HOT_TEXTS = 10_000  # different texts from which a collection is counted string by string
_PAD = 0xFF  # never a byte of UTF-8
_PARTS = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x9E3779B185EBCA87], dtype=U64)
_RADIX = (0xD1B54A32D192ED03, 0xABC98388FB8FAC03)
_RADIX_INVERSE = tuple(pow(r, -1, 1 << 64) for r in _RADIX)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < size:
        grown = np.full(max(size, BLOCK_BYTES + LENGTH + 1), base, dtype=U64)
        grown[0] = 1
        _powers[base] = np.multiply.accumulate(grown)
    return _powers[base]


class RangeHash:
    """Hash of any range of a byte array in constant time."""

    def __init__(self, data: np.ndarray, lane: int = 0):
        self._inverse = _power(_RADIX_INVERSE[lane], len(data) + 1)
        terms = (data.astype(U64) + U64(1)) * _power(_RADIX[lane], len(data) + 1)[: len(data)]
        self._total = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(terms, out=self._total[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self._total[stop] - self._total[start]) * self._inverse[start])


def anchor_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 24 bytes from each place."""
    size = len(data) - ANCHOR + 1
    if size <= 0:
        return np.zeros(0, dtype=U64)
    eight = np.zeros(len(data) - 7, dtype=U64)
    for k in range(8):
        eight |= data[k : len(data) - 7 + k].astype(U64) << U64(8 * k)
    total = np.zeros(size, dtype=U64)
    for k in range(ANCHOR // 8):
        part = eight[8 * k : 8 * k + size] * _PARTS[k]
        total = (total ^ part ^ (part >> U64(29))) * U64(0x9E3779B97F4A7C15)
    return mix(total)


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = len(values)
    padded = np.full(-(-size // width) * width, np.iinfo(np.uint64).max, dtype=U64)
    padded[:size] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: size - width + 1], ahead[width - 1 : size])


_FIELDS = ("document", "place", "first", "last", "anchor", "hash")


def anchored(offsets: np.ndarray, data: np.ndarray, length: int, hashed: bool = True) -> dict[str, np.ndarray]:
    """The texts of a chunk: document, anchor place, first and last start (in the document), anchor and content hash."""
    found: dict[str, list[np.ndarray]] = {f: [] for f in _FIELDS}
    width = length - ANCHOR + 1
    for begin in range(0, max(0, len(data) - length + 1), BLOCK_BYTES):
        part = data[begin : begin + BLOCK_BYTES + length - 1]
        hashes = anchor_hashes(part)
        # the upper half of the hash, then the place: among equal ones the leftmost counts
        keyed = (hashes >> U64(32) << U64(32)) | np.arange(len(hashes), dtype=U64)
        place = (_window_minimum(keyed, width) & U64(0xFFFFFFFF)).astype(np.int64)
        starts = np.arange(len(place))
        document = np.searchsorted(offsets, starts + begin, side="right") - 1
        inside = starts + begin + length <= offsets[document + 1]
        starts, place, document = starts[inside], place[inside], document[inside]
        if not len(starts):
            continue
        fresh = np.ones(len(starts), dtype=bool)
        fresh[1:] = (place[1:] != place[:-1]) | (document[1:] != document[:-1])
        at = np.flatnonzero(fresh)
        to = np.concatenate([at[1:], [len(starts)]]) - 1
        first, last, place, document = starts[at], starts[to], place[at], document[at]
        origin = offsets[document] - begin
        found["document"].append(document)
        found["place"].append(place - origin)
        found["first"].append(first - origin)
        found["last"].append(last - origin)
        found["anchor"].append(hashes[place])
        if hashed:
            shape = (place - first).astype(U64) * U64(0x9E3779B97F4A7C15) + (last - first).astype(U64)
            found["hash"].append(mix(RangeHash(part)(first, last + length) ^ mix(shape)))
    empty = {"anchor": U64, "hash": U64}
    return {f: np.concatenate(v) if v else np.zeros(0, empty.get(f, np.int64)) for f, v in found.items()}


def _anchor_counts(length: int):
    """(anchor, n) of every chunk, combined within it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, offsets, data in chunks(batch.column(0)):
                value, count = np.unique(anchored(offsets, data, length, hashed=False)["anchor"], return_counts=True)
                yield pa.record_batch([pa.array(value.view(np.int64)), pa.array(count.astype(np.int64))], names=["anchor", "n"])

    return run


def _texts(length: int):
    """(id, th, anchor, hash, place, first, last) of every text."""
    names = ["id", "th", "anchor", "hash", "place", "first", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, data in chunks(batch.column(2)):
                t = anchored(offsets, data, length)
                take = pa.array(t["document"] + row)
                yield pa.record_batch(
                    [batch.column(0).take(take), batch.column(1).take(take)]
                    + [pa.array(t[f].view(np.int64)) for f in ("anchor", "hash")]
                    + [pa.array(t[f].astype(np.int32)) for f in ("place", "first", "last")],
                    names=names,
                )

    return run


_BODY = "anchor long, hash long, before int, span int, body binary"


def _bodies(length: int):
    """Cut the wanted texts, a list for each document, out of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = (text or "").encode("utf-8")
                for w in wanted:
                    body = data[w["first"] : w["last"] + length]
                    rows.append((w["anchor"], w["hash"], w["place"] - w["first"], w["last"] - w["first"], body))
                if len(rows) >= 20_000:
                    yield _body_batch(rows)
                    rows = []
            if rows:
                yield _body_batch(rows)

    return run


def _body_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.record_batch(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["anchor", "hash", "before", "span", "body"]
    )


def _range_minimum(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Minimum of values[start:stop] for many ranges, from minima over powers of two."""
    level = np.frexp((stop - start).astype(np.float64))[1] - 1
    out = np.empty(len(start), dtype=values.dtype)
    table = values
    for k in range(int(level.max()) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[: len(table) - half], table[half:])
        here = np.flatnonzero(level == k)
        out[here] = np.minimum(table[start[here]], table[stop[here] - (1 << k)])
    return out


def sort_columns(bodies: list[bytes], before: np.ndarray, span: np.ndarray, length: int) -> np.ndarray:
    """Whether each start of each text repeats: rows are distances from the anchor, columns texts.

    One symbol of every text enters per round, from the last column to the first.
    """
    texts, widest = len(bodies), int(before.max())
    columns = np.full((widest + length, texts), _PAD, dtype=np.uint8)
    sizes = np.array([len(b) for b in bodies])
    owner = np.repeat(np.arange(texts), sizes)
    column = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(widest - before, sizes)
    columns[column, owner] = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    repeats = np.zeros((widest + 1, texts), dtype=bool)
    order = np.arange(texts)
    common = np.zeros(texts, dtype=np.uint16)  # with the text before it in the order
    for x in range(len(columns) - 1, -1, -1):
        symbols = columns[x][order]  # this round's part of the transform
        moved = np.argsort(symbols, kind="stable")
        symbols = symbols[moved]
        same = np.flatnonzero(symbols[1:] == symbols[:-1])
        grown = np.zeros(texts, dtype=np.uint16)
        if len(same):
            start, stop = moved[same] + 1, moved[same + 1] + 1
            near = stop - start == 1
            least = common[stop - 1]
            far = np.flatnonzero(~near)
            if len(far):
                least[far] = _range_minimum(common, start[far], stop[far])
            grown[same + 1] = np.minimum(least + 1, length)
        order, common = order[moved], grown
        if x <= widest:
            far_away = widest - x
            full = common >= length
            hit = full.copy()
            hit[:-1] |= full[1:]
            text = order[hit]
            owns = (far_away <= before[text]) & (far_away >= before[text] - span[text])
            repeats[far_away, text[owns]] = True
    return repeats


_RUNS = "anchor long, hash long, lo int, hi int"


def _repeated_starts(length: int):
    """Sort collection after collection; (anchor, hash, lo, hi) of runs of starts that repeat."""

    def done(rows: list[tuple]) -> pa.RecordBatch:
        anchor, key, before, span, bodies = zip(*rows)
        before, span = np.array(before), np.array(span)
        repeats = sort_columns(list(bodies), before, span, length)
        text, distance = np.nonzero(repeats.T[:, ::-1])  # by text, then by start
        start = before[text] - (len(repeats) - 1 - distance)
        fresh = np.ones(len(text), dtype=bool)
        fresh[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)
        at = np.flatnonzero(fresh)
        to = np.concatenate([at[1:], [len(text)]]) - 1 if len(at) else at
        of = text[at]
        return pa.record_batch(
            [
                pa.array(np.array(anchor, dtype=np.int64)[of]),
                pa.array(np.array(key, dtype=np.int64)[of]),
                pa.array(start[at].astype(np.int32)),
                pa.array(start[to].astype(np.int32)),
            ],
            names=["anchor", "hash", "lo", "hi"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in range(5)]):
                if len(rows) >= SORTED_TEXTS and row[0] != rows[-1][0]:
                    yield done(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield done(rows)

    return run


def _strings(length: int):
    """(anchor, hash, at, left, right): a 128-bit hash of every string of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, key, _, span, body in zip(*[batch.column(c).to_pylist() for c in range(5)]):
                data, at = np.frombuffer(body, dtype=np.uint8), np.arange(span + 1)
                lanes = [RangeHash(data, lane)(at, at + length).view(np.int64) for lane in (0, 1)]
                yield pa.record_batch(
                    [
                        pa.array(np.full(span + 1, anchor)),
                        pa.array(np.full(span + 1, key)),
                        pa.array(at.astype(np.int32)),
                        pa.array(lanes[0]),
                        pa.array(lanes[1]),
                    ],
                    names=["anchor", "hash", "at", "left", "right"],
                )

    return run


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n_bytes, kept, spans) of every document: spans are merged, touching ones too."""
    for batch in batches:
        kept, merged, sizes = [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data = (text or "").encode("utf-8")
            runs: list[list[int]] = []
            for span in sorted((s["start"], s["end"]) for s in spans or ()):
                if runs and span[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], span[1])
                else:
                    runs.append([*span])
            edges = [0, *[e for r in runs for e in r], len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            merged.append([{"start": a, "end": b} for a, b in runs])
            sizes.append(len(data))
        yield pa.record_batch(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(kept, pa.binary()),
                pa.array(merged, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ],
            names=["id", "n_bytes", "kept", "spans"],
        )


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, kept (the remaining bytes) and spans (the removed runs of bytes)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("th", F.xxhash64("text"))

    # anchors are found twice, once to count and once to keep: cheaper than storing those that occur once
    # stored, so that the join with a hot anchor's texts can be split
    often = scratch.store(
        source.select("text").mapInArrow(_anchor_counts(length), "anchor long, n long")
        .groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"),
        "often",
    )
    every = source.select("id", "th", "text").mapInArrow(
        _texts(length), "id long, th long, anchor long, hash long, place int, first int, last int"
    )
    texts = scratch.store(every.join(often, "anchor"), "texts")
    kinds = scratch.store(
        texts.groupBy("anchor", "hash").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("th", "id", "first", "last", "place")).alias("one"),
            F.max(F.col("last") - F.col("first")).alias("span"),
        ),
        "kinds",
    )
    whole = kinds.where("n > 1").select("anchor", "hash", F.lit(0).alias("lo"), F.col("span").alias("hi"))

    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    wanted = kinds.join(several, "anchor").select("anchor", "hash", "n", "kinds", "one.*")
    lists = wanted.groupBy(F.col("id").alias("wid"), F.col("th").alias("wth")).agg(
        F.collect_list(F.struct("anchor", "hash", "place", "first", "last")).alias("wanted")  # bounded by the document
    )
    bodies = scratch.store(
        source.join(lists, (source["th"] == lists["wth"]) & source["id"].eqNullSafe(lists["wid"]))
        .dropDuplicates(["th", "id"])
        .select("text", "wanted")
        .mapInArrow(_bodies(length), _BODY),
        "bodies",
    )
    hot = several.where(F.col("kinds") > HOT_TEXTS).select("anchor")
    usual = bodies.join(several.where(F.col("kinds") <= HOT_TEXTS).select("anchor"), "anchor")
    runs = (
        usual.select("anchor", "hash", "before", "span", "body")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "hash")
        .mapInArrow(_repeated_starts(length), _RUNS)
    )
    found = scratch.store(whole.union(runs), "runs")
    strings = bodies.join(hot, "anchor").select("anchor", "hash", "before", "span", "body").mapInArrow(
        _strings(length), "anchor long, hash long, at int, left long, right long"
    )
    if not hot.isEmpty():
        again = strings.groupBy("left", "right").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("left", "right")
        single = strings.join(again, ["left", "right"]).select("anchor", "hash", F.col("at").alias("lo"), F.col("at").alias("hi"))
        found = scratch.store(found.union(single), "runs")

    spans = (
        texts.join(found, ["anchor", "hash"])
        .select("id", "th", (F.col("first") + F.col("lo")).alias("start"), (F.col("first") + F.col("hi") + F.lit(length)).alias("end"))
        .groupBy(F.col("id").alias("sid"), F.col("th").alias("sth"))
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # bounded by the document
    )
    return (
        source.join(spans, (source["th"] == spans["sth"]) & source["id"].eqNullSafe(spans["sid"]), "left")
        .select("id", "text", "spans")
        .mapInArrow(_without, "id long, n_bytes long, kept binary, spans array<struct<start:int,end:int>>")
        .withColumnRenamed("id", id_column)
    )
