"""Periodic runs of words, and texts with their repetitions collapsed.

A run is a maximal stretch whose words ``period`` apart are identical, named by its
smallest period, of at least ``exponent`` periods and ``least`` words. Words are runs of
bytes other than space, tab, line feed, vertical tab, form feed and carriage return;
letter case counts.

The texts of a chunk are laid one after another, longest first, with a separator of its
own after each, and get one run-length grammar (``run_grammar``). A run of period p
covers at least ``exponent`` multiples of p, so it shows as equal words at neighbouring
points of the grid 0, p, 2p, ...; over all p the grids have n log n points. At every
(exponent - 1)-th pair of points that lies in a chain of enough equal words, the grammar
says exactly how far the period goes on to both sides. Points that lie in a run already
found, of a period that divides theirs, are passed over. Separators end every extension,
and texts shorter than ``exponent`` periods are left out of a grid, so runs stay inside
their text. Of the periods of one stretch the smallest is kept: all others are its
multiples.

Every text is handled alone, within one task and without a shuffle.

Defined results: a null, empty or blank text has no words, no runs and an empty collapsed
text; very long texts are handled whole, in a chunk of their own; repeated rows are
answered as often as they come; an empty table gives an empty result; columns of the
input are kept, and one named like a result is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultspan.llm.run_grammar import RunGrammar
from vaultspan.llm.words import chunks

QUERIES = 200_000  # extensions asked for at once

RUNS = "array<struct<start:long,length:long,period:long>>"


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and how many each text has."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    flat, offsets = split.values, split.offsets.to_numpy().astype(np.int64)
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    counts = before[offsets[1:]] - before[offsets[:-1]]
    return flat.slice(offsets[0], offsets[-1] - offsets[0]).filter(real.slice(offsets[0], offsets[-1] - offsets[0])), counts


def _grid_pairs(symbols: np.ndarray, stops: np.ndarray, counts: np.ndarray, least: int, exponent: int) -> Iterator[tuple[np.ndarray, int]]:
    """(first points, period) of the pairs of grid points to extend from; texts lie longest first."""
    chain = exponent - 1  # pairs of neighbouring points that any run of the period holds
    longest = int(counts[0]) if len(counts) else 0
    for period in range(1, longest // exponent + 1):
        texts = int(np.searchsorted(-counts, -max(least, exponent * period), side="right"))
        if not texts:
            return
        points = symbols[: stops[texts - 1] : period]
        equal = points[1:] == points[:-1]
        hits = np.flatnonzero(equal[::chain]) * chain
        if len(hits):
            around = np.concatenate([np.zeros(chain, bool), equal, np.zeros(chain, bool)])
            windows = [np.logical_and.reduce([around[hits + chain - k + m] for m in range(chain)]) for k in range(chain)]
            hits = hits[np.logical_or.reduce(windows)]
            if len(hits):
                yield hits * period, period


def find_runs(symbols: np.ndarray, counts: np.ndarray, least: int = 6, exponent: int = 4) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of every run, by text, start and period.

    ``symbols`` are the non-negative word numbers of the texts one after another,
    ``counts`` how many each text has.
    """
    if exponent < 2:
        raise ValueError("a run must hold at least two periods")
    order = np.argsort(-counts, kind="stable")
    sizes = counts[order]
    begins = np.cumsum(sizes + 1) - sizes  # one separator before the first text, one after each
    laid = np.empty(len(symbols) + len(counts) + 1, dtype=np.int64)
    separators = np.append(0, begins + sizes)
    laid[separators] = -1 - np.arange(len(separators))
    source = np.cumsum(counts) - counts
    within = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    laid[np.repeat(begins, sizes) + within] = symbols[np.repeat(source[order], sizes) + within]

    found: list[np.ndarray] = []
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    grammar = None
    inside, until = np.zeros(len(laid), dtype=np.int64), np.zeros(len(laid), dtype=np.int64)  # period and end of a known run

    def extend() -> None:
        nonlocal grammar
        grammar = grammar or RunGrammar(laid)
        at, period = (np.concatenate(c) for c in zip(*waiting))
        waiting.clear()
        for cut in range(0, len(at), QUERIES):
            i, p = at[cut : cut + QUERIES], period[cut : cut + QUERIES]
            back, length = grammar.backward(i, i + p), grammar.forward(i, i + p) + p
            start, length = i - back, length + back
            good = length >= np.maximum(least, exponent * p)
            # unique at once: a long run is met from many points
            found.append(np.unique(np.stack([start[good], length[good], p[good]], axis=1), axis=0))
            for begin, size, q in found[-1].tolist():
                inside[begin : begin + size], until[begin : begin + size] = q, begin + size

    held, wave = 0, 1
    for at, period in _grid_pairs(laid, begins + sizes, sizes, least, exponent):
        if waiting and (held >= QUERIES or period >= wave):
            extend()
            held = 0
        while period >= wave:
            wave *= 2
        # both points in one run whose period divides this one: the extension is that run, or too short
        at = at[(period % np.maximum(inside[at], 1) > 0) | (until[at] <= at + period)]
        if len(at):
            waiting.append((at, np.full(len(at), period)))
            held += len(at)
    if waiting:
        extend()
    runs = np.concatenate([np.zeros((0, 3), dtype=np.int64), *found])
    if not len(runs):
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    same = (runs[1:, 0] == runs[:-1, 0]) & (runs[1:, 1] == runs[:-1, 1])
    start, length, period = runs[np.append(True, ~same)].T
    place = np.searchsorted(begins, start, side="right") - 1
    text, start = order[place], start - begins[place]
    by = np.lexsort((period, start, text))
    return text[by], start[by], length[by], period[by]


def _collapsed(words: pa.Array, counts: np.ndarray, runs: tuple[np.ndarray, ...]) -> pa.Array:
    """The texts without what a run repeats: of each run the first period stays, other runs permitting."""
    text, start, length, period = runs
    base = (np.cumsum(counts) - counts)[text] + start
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(drop, base + period, 1)
    np.add.at(drop, base + length, -1)
    keep = np.cumsum(drop[:-1]) == 0
    before = np.concatenate([[0], np.cumsum(keep)])
    offsets = before[np.concatenate([[0], np.cumsum(counts)])]
    kept = words.filter(pa.array(keep))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), kept), pa.scalar(" ", pa.large_string()))


def periodic_runs(
    docs: DataFrame,
    text_column: str = "text",
    least: int = 6,
    exponent: int = 4,
    runs_column: str = "runs",
    collapsed_column: str = "collapsed",
    count_column: str = "n_words",
) -> DataFrame:
    """Add the number of words, the runs (by start, then period) and the collapsed text of every text."""
    results = (count_column, runs_column, collapsed_column)
    kept = [c for c in docs.columns if c not in results]
    # the text goes through Python once more under its own name; other columns ride along untouched
    passed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), docs[text_column].cast("string").alias("text"))
    schema = T.StructType([passed.schema["row"]])
    schema = schema.add("n", T.LongType()).add("runs", T._parse_datatype_string(RUNS)).add("collapsed", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = batch.column(0), batch.column(1)
            for row, offsets, _ in chunks(texts):
                size = len(offsets) - 1
                words, counts = _words(texts.slice(row, size))
                numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
                runs = find_runs(numbers, counts, least, exponent)
                per_text = np.concatenate([[0], np.cumsum(np.bincount(runs[0], minlength=size))])
                listed = pa.ListArray.from_arrays(
                    pa.array(per_text, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in runs[1:]], ["start", "length", "period"]),
                )
                yield pa.record_batch(
                    [rows.slice(row, size), pa.array(counts, pa.int64()), listed, _collapsed(words, counts, runs).cast(pa.string())],
                    names=["row", "n", "runs", "collapsed"],
                )

    done = passed.mapInArrow(run, schema)
    return done.select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept],
        F.col("n").alias(count_column), F.col("runs").alias(runs_column), F.col("collapsed").alias(collapsed_column),
    )
