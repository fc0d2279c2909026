"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms: words and their first four to seven bytes
(lower-case, ASCII punctuation parts words), as 64-bit hashes. The score is
the logistic of w0 + sum of w_i + sum over pairs of <v_i, v_j>, so a term can weigh
more beside another than alone. Labels enter by a bounded sample of labelled
documents: ``per_class`` of each label, those with the smallest hash of the id, and
of an id that comes repeatedly the text with the smallest hash.
On the sample, terms are chosen by their likelihood ratio against the label (a hash
outside this table has no weight), then the machine is fitted. The model has at most
``most_terms`` terms and is applied to every whole text in one pass without a shuffle.

Defined results: a null or blank text has no terms and scores the intercept; without
labelled documents, or with one label only, every score is the smoothed share of
label 1; labels that are null are ignored, of repeated ones the largest counts;
repeated rows score alike; labels of unknown documents and other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultspan.llm.scratch import Scratch, unused
from vaultspan.llm.words import U64, Words, chunks

FACTORS = 8
CHUNK = 512 << 10  # a word has five terms, so a chunk takes some fifty times its bytes
LEAST_RATIO = 10.0
_PREFIXES = (4, 5, 6, 7)
_SEPARATED = np.arange(256, dtype=np.uint8)
_SEPARATED[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 0x20


@dataclass
class Machine:
    terms: np.ndarray  # sorted 64-bit hashes
    linear: np.ndarray
    factors: np.ndarray
    intercept: float

    def raw(self, document: np.ndarray, term: np.ndarray, documents: int) -> np.ndarray:
        """Scores before the logistic, of (document, position of term) pairs that occur once."""
        total = self.intercept + np.bincount(document, self.linear[term], documents)
        for f in range(self.factors.shape[1]):
            v = self.factors[term, f]
            total += 0.5 * (np.bincount(document, v, documents) ** 2 - np.bincount(document, v * v, documents))
        return total


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def terms_of(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, term) of a chunk, with repetitions."""
    words = Words(offsets, _SEPARATED[data])
    parts = [words.hash] + [words.prefix_hash(n) ^ U64(n) for n in _PREFIXES]
    return np.tile(words.document, len(parts)), np.concatenate(parts)


def is_held_out(id_column: Column) -> Column:
    """Rows whose crc32 of the id as text leaves 1 modulo 3: never trained on."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """The bounded sample (id, text, label), and all usable labels."""
    marked = (
        labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull() & ~is_held_out(F.col(id_column)))
        .groupBy(F.col(id_column).cast("long").alias("id"))
        .agg(F.max(F.col(label)).cast("int").alias("label"))
    )
    known = marked.join(docs.select(F.col(id_column).cast("long").alias("id")).distinct(), "id", "left_semi")
    order = [F.xxhash64("id"), F.col("id")]
    chosen = known.where("label = 1").orderBy(*order).limit(per_class).union(known.where("label = 0").orderBy(*order).limit(per_class))
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    held = texts.join(F.broadcast(chosen), "id")
    # many rows can have one id: one text of each, so at most 2 * per_class rows
    return held.groupBy("id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("label").alias("label")), known


def _by_document(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, term), each pair once, sorted by document."""
    document, term = terms_of(offsets, data)
    order = np.lexsort((term, document))
    document, term = document[order], term[order]
    fresh = np.ones(len(term), dtype=bool)
    fresh[1:] = (term[1:] != term[:-1]) | (document[1:] != document[:-1])
    return document[fresh], term[fresh]


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, documents of label 1 that hold it, of label 0), combined within a chunk."""
    for batch in batches:
        labels = batch.column(2).to_numpy(zero_copy_only=False)
        for row, offsets, data in chunks(batch.column(1), CHUNK):
            document, term = _by_document(offsets, data)
            one = labels[row : row + len(offsets) - 1][document] == 1
            value, spot = np.unique(term, return_inverse=True)
            counts = [np.bincount(spot, k, len(value)).astype(np.int64) for k in (one, ~one)]
            yield pa.record_batch([pa.array(value.view(np.int64)), *map(pa.array, counts)], names=["term", "ones", "zeros"])


def _chosen_terms(chosen: np.ndarray):
    """(label, terms) of every document, its terms cut down to the chosen ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, data in chunks(batch.column(1), CHUNK):
                documents = len(offsets) - 1
                document, term = _by_document(offsets, data)
                held = np.isin(term, chosen)
                document, term = document[held], term[held]
                cut = np.searchsorted(document, np.arange(documents + 1))
                sets = [term[cut[i] : cut[i + 1]].tobytes() for i in range(documents)]
                yield pa.record_batch([batch.column(2).slice(row, documents), pa.array(sets, pa.binary())], names=["label", "terms"])

    return run


def _ratio_column(ones: int, zeros: int) -> Column:
    """``_likelihood_ratio`` of the columns ``ones`` and ``zeros``; 0 for terms that speak for label 0."""
    total, held = float(ones + zeros), F.col("ones") + F.col("zeros")
    share = ones / total

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    ratio = 2 * (
        part(F.col("ones"), held * share)
        + part(F.col("zeros"), held * (1 - share))
        + part(F.lit(ones) - F.col("ones"), F.greatest((total - held) * share, F.lit(1e-9)))
        + part(F.lit(zeros) - F.col("zeros"), F.greatest((total - held) * (1 - share), F.lit(1e-9)))
    )
    return F.when(F.col("ones") / float(ones) < F.col("zeros") / float(zeros), F.lit(0.0)).otherwise(ratio)


def _likelihood_ratio(in_one: np.ndarray, in_zero: np.ndarray, ones: int, zeros: int) -> np.ndarray:
    """G squared of the two-by-two table of term and label."""

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / expected), 0.0)

    total, with_term = ones + zeros, in_one + in_zero
    without = total - with_term
    share = ones / total
    return 2 * (
        part(in_one, with_term * share)
        + part(in_zero, with_term * (1 - share))
        + part(ones - in_one, np.maximum(without * share, 1e-9))
        + part(zeros - in_zero, np.maximum(without * (1 - share), 1e-9))
    )


def fit_machine(term_sets: list[np.ndarray], labels: np.ndarray, prior: float, most_terms: int, least_ratio: float = LEAST_RATIO, turns: int = 200) -> Machine:
    """Choose terms and fit by Adam on the whole sample; the same sample gives the same machine."""
    ones, zeros = int((labels == 1).sum()), int((labels == 0).sum())
    base = float(np.log(prior / (1 - prior)))
    if not ones or not zeros:
        return Machine(np.zeros(0, U64), np.zeros(0), np.zeros((0, FACTORS)), base)
    flat = np.concatenate(term_sets)
    owner = np.repeat(np.arange(len(term_sets)), [len(t) for t in term_sets])
    vocabulary, spot = np.unique(flat, return_inverse=True)
    in_one = np.bincount(spot, labels[owner] == 1, len(vocabulary))
    in_zero = np.bincount(spot, labels[owner] == 0, len(vocabulary))
    ratio = _likelihood_ratio(in_one, in_zero, ones, zeros)
    ratio[in_one / ones < in_zero / zeros] = 0  # absence of harmless terms is no sign of harm
    order = np.lexsort((vocabulary, -ratio))[:most_terms]
    chosen = np.sort(order[ratio[order] >= least_ratio])
    terms = vocabulary[chosen]
    x = np.zeros((len(term_sets), len(terms)), dtype=np.float32)
    place = np.searchsorted(terms, flat)
    hit = place < len(terms)
    hit[hit] = terms[place[hit]] == flat[hit]
    x[owner[hit], place[hit]] = 1
    y = labels.astype(np.float32)
    weight = np.where(y == 1, 0.5 / ones, 0.5 / zeros).astype(np.float32)  # both labels weigh the same
    draw = np.random.default_rng(7)
    state = [np.zeros(1, np.float32), np.zeros(len(terms), np.float32), draw.normal(0, 0.05, (len(terms), FACTORS)).astype(np.float32)]
    first, second = [np.zeros_like(p) for p in state], [np.zeros_like(p) for p in state]
    for turn in range(1, turns + 1):
        sums = x @ state[2]
        raw = state[0] + x @ state[1] + 0.5 * ((sums**2).sum(1) - x @ (state[2] ** 2).sum(1))
        error = (logistic(raw) - y).astype(np.float32) * weight
        by_term = x.T @ error
        steps = [
            error.sum(keepdims=True),
            by_term + 1e-4 * state[1],
            x.T @ (error[:, None] * sums) - state[2] * by_term[:, None] + 1e-3 * state[2],
        ]
        for p, g, m, s in zip(state, steps, first, second):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= 0.1 * (m / (1 - 0.9**turn)) / (np.sqrt(s / (1 - 0.999**turn)) + 1e-8)
    return Machine(terms, state[1].astype(float), state[2].astype(float), float(state[0][0]) + 0.25 * base)


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 4000, most_terms: int = 1024,
    id_column: str = "doc_id", text_column: str = "text",
) -> Machine:
    """Fit on at most ``per_class`` labelled documents of each label; their chosen terms reach the driver."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample, known = _sample(docs, labels, label, per_class, id_column, text_column)
    counted = known.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).first()
    prior = ((counted["ones"] or 0) + 1) / (counted["n"] + 2)
    sample = scratch.store(sample, "sample")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not ones or not zeros:
        return fit_machine([], np.zeros(0, int), prior, most_terms)
    best = (
        sample.mapInArrow(_term_counts, "term long, ones long, zeros long")
        .groupBy("term").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
        .withColumn("ratio", _ratio_column(ones, zeros)).where(F.col("ratio") >= LEAST_RATIO)
        .orderBy(F.desc("ratio"), "term").limit(most_terms).select("term")
    )
    chosen = np.array([r["term"] for r in best.collect()], dtype=np.int64).view(U64)
    rows = sample.mapInArrow(_chosen_terms(np.sort(chosen)), "label int, terms binary").collect()
    scratch.drop(sample)
    rows.sort(key=lambda r: (r["label"], bytes(r["terms"])))  # the order of partitions must not matter
    sets = [np.frombuffer(r["terms"], dtype=U64) for r in rows]
    return fit_machine(sets, np.array([r["label"] for r in rows]), prior, most_terms)


def score(docs: DataFrame, machine: Machine, text_column: str = "text", column: str = "score") -> DataFrame:
    """Add the score of every text; a column of that name is replaced."""
    text = unused(docs.columns, "_text")
    rows = docs.select([docs[c] for c in docs.columns if c != column] + [docs[text_column].cast("string").alias(text)])
    schema = rows.drop(text).schema.add(column, "double")
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            kept = batch.num_columns - 1
            for row, offsets, data in chunks(batch.column(kept), CHUNK):
                documents = len(offsets) - 1
                document, term = terms_of(offsets, data)
                place = np.searchsorted(own.terms, term)
                hit = place < len(own.terms)
                hit[hit] = own.terms[place[hit]] == term[hit]
                pairs = np.unique(document[hit] * np.int64(max(1, len(own.terms))) + place[hit])
                size = max(1, len(own.terms))
                values = logistic(own.raw(pairs // size, pairs % size, documents))
                part = batch.slice(row, documents)
                yield pa.record_batch([part.column(i) for i in range(kept)] + [pa.array(values)], names=batch.schema.names[:kept] + [column])

    return rows.mapInArrow(run, schema)
