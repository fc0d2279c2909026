"""Spelling variants: words one edit apart, found by blocked Gram matrices.

Two words are near if they differ by exactly one inserted, deleted or replaced code point.
One edit changes the counts of letters by one up, one down, or both, so the squared
distance of near words' letter counts is at most two, and that is a matrix product away:
|a|^2 + |b|^2 - 2 ab. Words are dealt into blocks by their length and by how many
letters of each of ``d`` letter groups they have. Near words lie in the same block or in blocks
one step apart: the same length with a letter moved from a group to another, or the next length
with a letter more in one group. So a block's Gram matrices with itself and with these
neighbours hold every pair once, and each pair within the distance is verified letter by letter.

``d`` follows the vocabulary: the least for which the average word shares its block with few
others. A block larger than ``BLOCK_BYTES`` is cut into chunks, and what a chunk meets into
slots, so no task holds more than a chunk and a slot, and all pairs are still met. Of a
task only counts and the best partner per word leave, no pairs.

A word's form is its near word of largest count (then the smallest in code-point order), if
that is ``ratio`` times its own or more; the root is where following forms ends. Counts grow
along forms, so there are no circles.

Defined results: a null, empty or blank text has no runs; very long texts and very long runs are
taken whole; repeated rows count as often as they come; an empty table gives an empty result; other
columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultspan.llm.scratch import Scratch

RUN = r"[A-Za-zÀ-ÿ]"  # the letters, all of them in Latin-1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Letters are dealt to groups round robin in this order, so groups get like shares of common letters.
BY_USE = "eaionrtslducmphgbfvykwxzjq"
SHARED_BLOCK = 1_000  # words that the average word shares its block with, at most, if more groups help
GROUPS = (2, 3, 4, 5, 6, 7, 8)
BLOCK_BYTES = 256 << 10  # letters of a chunk of a block
SLOT_BYTES = 2 << 20  # letters of what a chunk meets in a task
TILE = 1_024  # rows of a Gram matrix
EXACT_IN_SINGLE = 2_048  # up to this length squared counts are exact in single precision

COLUMNS = 64
CENTRAL, OWN, OTHER = 0, 1, 2  # roles in a task: of its chunk, met in the same block, met in another


def _column_of_letter() -> np.ndarray:
    """Columns of the count matrix; the rarer accented letters share, which only lowers distances."""
    table = np.zeros(256, dtype=np.int64)
    table[97:123] = np.arange(26)
    table[0xC0:] = 26 + np.arange(64) % (COLUMNS - 26)
    return table


_COLUMN = _column_of_letter()


def occurrences(docs: DataFrame, text_column: str = "text", least: int = 1) -> DataFrame:
    """A row per run of at least ``least`` letters, only A-Z lower-cased; all other columns are kept.

    Runs are maximal, so the pattern finds exactly the runs that are long enough.
    """
    text = F.coalesce(docs[text_column].cast("string"), F.lit(""))
    runs = F.regexp_extract_all(text, F.lit(f"{RUN}{{{least},}}"), F.lit(0))
    kept = [docs[c] for c in docs.columns if c not in (text_column, "word")]
    return docs.select(*kept, F.explode(F.transform(runs, lambda run: F.translate(run, UPPER, LOWER))).alias("word"))


def without_letter(word: Column, place: Column) -> Column:
    """The word less its code point at ``place``, from 0."""
    return F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.length(word)))


def _groups(count: int) -> list[str]:
    accented = [chr(c) for c in range(0xC0, 0x100)]
    return ["".join([*BY_USE[k::count], *accented[k::count]]) for k in range(count)]


def _shape(count: int) -> Column:
    """[length, letters of group 1, ..., of group count - 1]; the last group is what is left."""
    word = F.col("word")
    held = [F.length(word) - F.length(F.translate(word, letters, "")) for letters in _groups(count)[:-1]]
    return F.array(F.length(word), *held)


def _steps(count: int) -> list[list[int]]:
    """What is added to a shape to reach the neighbours that it meets as the centre, itself included."""
    unit = np.vstack([np.eye(count - 1, dtype=int), np.zeros((1, count - 1), dtype=int)]) if count > 1 else np.zeros((1, 0), int)
    moved = [unit[j] - unit[i] for i in range(count) for j in range(i + 1, count)]
    return [[0] * count, *([0, *m.tolist()] for m in moved), *([1, *u.tolist()] for u in unit)]


def _grouped(vocabulary: DataFrame) -> int:
    """How many letter groups to use."""
    for count in GROUPS:
        sizes = vocabulary.groupBy(_shape(count).alias("shape")).agg(F.count(F.lit(1)).cast("double").alias("m"))
        row = sizes.agg(F.sum(F.col("m") * F.col("m")).alias("pairs"), F.sum("m").alias("words")).first()
        if not row["words"] or row["pairs"] / row["words"] <= SHARED_BLOCK:
            break
    return count


def _tasks(scratch: Scratch, vocabulary: DataFrame) -> DataFrame:
    """(task, role, word, n): every word once per chunk and slot that it has to meet others in."""
    count = _grouped(vocabulary)
    steps = F.array(*[F.array(*[F.lit(int(v)) for v in step]) for step in _steps(count)])
    shaped = vocabulary.withColumn("shape", _shape(count))
    blocks = scratch.store(shaped.groupBy("shape").agg(F.sum(F.length("word").cast("long")).alias("bytes")), "blocks")
    meets = blocks.select(
        F.col("shape").alias("centre"), F.explode(F.transform(steps, lambda s: F.zip_with("shape", s, lambda a, b: a + b))).alias("shape")
    )
    # only blocks that exist; what a centre meets in all of them sets its number of slots
    meets = meets.join(blocks, "shape")
    parts = meets.groupBy("centre").agg(F.ceil(F.sum("bytes") / SLOT_BYTES).alias("slots")).join(
        blocks.select(F.col("shape").alias("centre"), F.ceil(F.col("bytes") / BLOCK_BYTES).alias("chunks")), "centre"
    )
    meets = meets.select("centre", "shape").join(parts, "centre")
    chunk, slot = F.pmod(F.xxhash64("word"), F.col("chunks")), F.pmod(F.xxhash64("word", F.lit(1)), F.col("slots"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    central = shaped.join(parts, F.col("shape") == F.col("centre")).select(
        "centre", chunk.alias("chunk"), every("slots").alias("slot"), F.lit(CENTRAL).alias("role"), "word", "n"
    )
    met = shaped.join(meets, "shape").select(
        "centre", every("chunks").alias("chunk"), slot.alias("slot"), F.when(F.col("shape") == F.col("centre"), OWN).otherwise(OTHER).alias("role"), "word", "n"
    )
    return central.unionByName(met).select(F.xxhash64("centre", "chunk", "slot").alias("task"), F.col("role").cast("byte").alias("role"), "word", "n")


class _Letters:
    """Words as a matrix of Latin-1 letters, filled up with 0, by length."""

    def __init__(self, words: pa.Array):
        words = words.cast(pa.large_binary())
        _, where, what = words.buffers()
        offsets = np.frombuffer(where, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(what, dtype=np.uint8)[offsets[0] : offsets[-1]] if len(words) else np.zeros(0, np.uint8)
        lead = data == 0xC3  # the letters beyond ASCII are 0xC3 and one more byte in UTF-8
        first = np.cumsum(np.append(0, ~lead))[offsets - offsets[0]]
        kept = data[~lead]
        self.flat = np.where(kept >= 0x80, kept + 0x40, kept).astype(np.uint8)
        self.first, self.size = first[:-1], np.diff(first)

    def matrix(self, rows: np.ndarray) -> np.ndarray:
        """Letters of words of one length."""
        length = int(self.size[rows[0]]) if len(rows) else 0
        return self.flat[self.first[rows][:, None] + np.arange(length)]

    def counts(self, rows: np.ndarray, kind: type) -> np.ndarray:
        letters = _COLUMN[self.matrix(rows)]
        at = letters + (np.arange(len(rows)) * COLUMNS)[:, None]
        return np.bincount(at.ravel(), minlength=len(rows) * COLUMNS).reshape(len(rows), COLUMNS).astype(kind)


def _one_edit(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether the words of each row are one edit apart; lengths are equal or differ by one."""
    size = shorter.shape[1]
    if size == longer.shape[1]:
        return (shorter != longer).sum(axis=1) == 1
    ahead, behind = shorter != longer[:, :-1], shorter != longer[:, 1:]
    first = np.where(ahead.any(axis=1), ahead.argmax(axis=1), size)
    last = np.where(behind.any(axis=1), size - 1 - behind[:, ::-1].argmax(axis=1), -1)
    return last < first


def near_pairs(words: pa.Array, centre: np.ndarray, met: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (of the centre, met) of near words; the words of the centre have one length, those met that or the next."""
    letters = _Letters(words)
    if not len(centre) or not len(met):
        return
    length = int(letters.size[centre[0]])
    kind = np.float32 if length < EXACT_IN_SINGLE else np.float64
    for size in (length, length + 1):
        others = met[letters.size[met] == size]
        for a in range(0, len(centre), TILE):
            left = centre[a : a + TILE]
            x = letters.counts(left, kind)
            own = (x * x).sum(axis=1)[:, None]
            for b in range(0, len(others), TILE):
                right = others[b : b + TILE]
                y = letters.counts(right, kind)
                gram = x @ y.T
                gram *= -2
                gram += own
                gram += (y * y).sum(axis=1)[None, :]
                i, j = np.nonzero(gram <= 2)
                for cut in range(0, len(i), step := max(1, (16 << 20) // size)):
                    u, v = left[i[cut : cut + step]], right[j[cut : cut + step]]
                    if len(u):
                        good = _one_edit(letters.matrix(u), letters.matrix(v))
                        yield u[good], v[good]


def _partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and word with near words there: their number, and count and word of the best."""

    def answered(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()
        if not rows:
            return None
        role = rows[0].column(1).to_numpy()
        coded = rows[0].column(2).dictionary_encode()
        words, n = coded.dictionary, rows[0].column(3).to_numpy()
        code = coded.indices.to_numpy()
        rank = np.empty(len(words), dtype=np.int64)  # UTF-8 orders like code points
        rank[pa.compute.sort_indices(words.cast(pa.binary())).to_numpy()] = np.arange(len(words))
        total = np.zeros(len(words), dtype=np.int64)
        total[code] = n
        # once each and by length: two blocks whose keys collide would share a task
        centre, own, met = np.unique(code[role == CENTRAL]), np.unique(code[role == OWN]), np.unique(code[role != CENTRAL])
        sizes = pa.compute.utf8_length(words).to_numpy()
        pairs = []
        for size in np.unique(sizes[centre]).tolist():
            pairs += near_pairs(words, centre[sizes[centre] == size], met)
        if not pairs:
            return None
        u, v = (np.concatenate(c) for c in zip(*pairs))
        good = ~np.isin(v, own) | (rank[u] < rank[v])  # a pair of one block is met from both sides
        u, v = np.concatenate([u[good], v[good]]), np.concatenate([v[good], u[good]])
        order = np.lexsort((rank[v], -total[v], u))
        u, v = u[order], v[order]
        first = np.flatnonzero(np.append(True, u[1:] != u[:-1])) if len(u) else np.zeros(0, np.int64)
        near = np.diff(np.append(first, len(u)))
        return pa.record_batch(
            [words.take(pa.array(u[first])), pa.array(near, pa.int64()), pa.array(total[v[first]], pa.int64()), words.take(pa.array(v[first]))],
            names=["word", "near", "best_n", "best"],
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        tasks = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(tasks[1:] != tasks[:-1]) + 1).tolist(), len(tasks)]
        for start, stop in zip(cuts[:-1], cuts[1:]):
            if held and stop > start and held[-1].column(0)[0].as_py() != tasks[start]:
                if (done := answered(held)) is not None:
                    yield done
                held = []
            if stop > start:
                held.append(batch.slice(start, stop - start))
    if held and (done := answered(held)) is not None:
        yield done


def variants(scratch: Scratch, words: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``words`` that is long and frequent enough.

    ``words`` has a row per occurrence in column ``word``; its letters are those of ``RUN``, lower-cased as ``occurrences`` does.
    """
    vocabulary = scratch.store(
        words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count), "vocabulary"
    )
    tasks = _tasks(scratch, vocabulary)
    found = tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_partners, "word string, near long, best_n long, best string")
    best = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
    strong = -F.col("b.m") >= F.lit(ratio) * F.col("n")
    formed = vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, F.col("b.best")).alias("form"), F.when(strong, -F.col("b.m")).alias("form_n"),
    )
    formed = scratch.store(formed, "formed")
    return formed.join(_roots(scratch, formed), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "form", "word").alias("root")
    )


def _roots(scratch: Scratch, formed: DataFrame) -> DataFrame:
    """The root of every word whose form has a form, by doubling: as many rounds as the logarithm of the longest way."""
    ways = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = ways.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        stepped = scratch.store(joined, "roots")
        ways = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            return ways
