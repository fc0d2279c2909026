"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct runs of five words (64-bit hashes). Its
sketch is a row of words into which every member is XORed at one hashed place, so
two sketches differ in at most as many places as the sets' symmetric difference
has members. Two sets of a and b members with similarity 0.8 differ in at most
(a + b) / 9 members; a sketch of more places than that must agree in some
non-empty place (pigeonhole), and equal places are found by an equality join.

* Sizes fall into bands. A band fixes the number of places, a document enters
  its own band and the next one where a larger partner may be.
* A document knows how many non-empty places it must share with any partner. A
  document that shares fewer (a common passage makes it share a few) is dropped
  before anything is compared. A document with too many empty places to have such
  a bound is also entered under each of its members, an exact way for the rest.
* Of the places a document shares, it meets others under all but its commonest
  ``need - 1``, where ``need`` is the bound. Two documents that share that many meet
  under a rarer one too (prefix filter on one order of all keys), and a line that many
  documents have in common does not tie them together.
* Documents that share places so form candidate groups. Inside a group, cut into
  blocks, dense bit sketches are compared by Hamming distance, again a lower bound
  of the symmetric difference, and what passes is verified on the sets. Only link
  counts and a spanning forest of the links leave a block, never all its pairs.

Equal sets are one class from the start, so copies are never compared. The
places travel as packed arrays, a bucket is folded as a stream: its memory is its
distinct places, however many documents share one.

Defined results: null or blank text is the empty set, which is linked with
nothing, not even another empty set; repeated rows are documents of their own and
linked through their equal sets; null ids are allowed and count as no smallest
id; other columns of the input are never read; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultspan.llm.components import components
from vaultspan.llm.scratch import Scratch
from vaultspan.llm.words import U64, Words, chunks, mix, shingles

# The similarity threshold is 8 / 10.
BAND_GROWTH = 1.6
BUCKET_ENTRIES = 1_000_000
FOLD_ENTRIES = 500_000
BLOCK_MEMBERS = 500_000
BROADCAST_ROWS = 250_000
MEMBER_KEYS = 100  # band numbers from here on: entries under single members

_CLASS_SEED, _PLACE_SEED, _BIT_SEED = U64(0x243F6A8885A308D3), U64(0x13198A2E03707344), U64(0xA4093822299F31D0)


def _bands() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest size, largest size and number of places of each band."""
    low, lows, highs = 1, [], []
    while low < 1 << 40:
        high = max(low, int(low * BAND_GROWTH))
        lows.append(low)
        highs.append(high)
        low = high + 1
    highs = np.array(highs)
    most = 2 * highs // 9
    places = np.where(most == 0, 0, most + 1 + np.maximum(1, -(-most // 10)))
    return np.array(lows), highs, places


LOWS, HIGHS, PLACES = _bands()


def band_of(sizes: np.ndarray) -> np.ndarray:
    return np.searchsorted(LOWS, sizes, side="right") - 1


def _most_apart(sizes: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """Largest symmetric difference with a partner of similarity 0.8 in the band."""
    return (sizes + np.minimum(sizes * 10 // 8, HIGHS[bands])) // 9


def class_hash(document: np.ndarray, members: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, hash) of every set; equal sets have equal hashes."""
    sizes = np.bincount(document, minlength=documents)
    sums = np.zeros(documents, dtype=U64)
    xors = np.zeros(documents, dtype=U64)
    if len(members):
        filled = np.flatnonzero(sizes)
        first = (np.cumsum(sizes) - sizes)[filled]
        sums[filled] = np.add.reduceat(mix(members ^ _CLASS_SEED), first)
        xors[filled] = np.bitwise_xor.reduceat(members, first)
    return sizes, mix(sums * U64(0x9E3779B97F4A7C15) ^ mix(xors + sizes.astype(U64)))


def _sketch(document: np.ndarray, members: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, ...]:
    """The filled places of each document's sketch in its band: (document, key), and its empty places."""
    places = PLACES[bands]
    offset = np.cumsum(places) - places
    spread = mix(members ^ (_PLACE_SEED + bands[document].astype(U64))) >> U64(32)
    place = ((spread * places[document].astype(U64)) >> U64(32)).astype(np.int64)
    where = offset[document] + place
    words = np.zeros(int(places.sum()), dtype=U64)
    np.bitwise_xor.at(words, where, mix(members + _PLACE_SEED))
    filled = np.zeros(len(words), dtype=bool)
    filled[where] = True
    owner = np.repeat(np.arange(len(bands)), places)
    place = np.arange(len(words)) - offset[owner]
    empty = places - np.bincount(owner[filled], minlength=len(bands))
    salt = mix((bands[owner].astype(U64) << U64(40)) + place.astype(U64))
    return owner[filled], mix(words ^ salt)[filled], empty


def entries(document: np.ndarray, members: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, key, band, places it must share) under which documents meet partners."""
    own = band_of(np.maximum(sizes, 1))
    for step in (0, 1):
        bands = own + step
        enters = (sizes > 0) & (PLACES[bands] > 0)
        if step:
            enters &= 10 * sizes >= 8 * LOWS[bands]
        if not enters.any():
            continue
        new = np.cumsum(enters) - 1
        back = np.flatnonzero(enters)
        chosen = enters[document]
        owner, key, empty = _sketch(new[document[chosen]], members[chosen], bands[back])
        share = PLACES[bands[back]] - _most_apart(sizes[back], bands[back]) - empty
        yield back[owner], key, bands[back][owner], np.maximum(share, 1)[owner]
        short = np.zeros(len(sizes), dtype=bool)
        short[back[share <= 0]] = True
        if short.any():
            chosen = short[document]
            owner = document[chosen]
            key = mix(members[chosen] ^ (_BIT_SEED + bands[owner].astype(U64)))
            yield owner, key, bands[owner] + MEMBER_KEYS, -(-8 * sizes[owner] // 10)  # of the union, so of each set


def _summaries(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, data in chunks(batch.column(1)):
                documents = len(offsets) - 1
                sizes, classes = class_hash(*shingles(Words(offsets, data), documents, words), documents)
                kept = [batch.column(i).slice(row, documents) for i in range(batch.num_columns) if i != 1]
                yield pa.record_batch(
                    kept + [pa.array(sizes.astype(np.int64)), pa.array(classes.view(np.int64))],
                    names=["id", *batch.schema.names[2:], "n", "cls"],
                )

    return run


def _dealt(classes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """First bucket and number of buckets of each band, none where no document enters; a bucket has a bounded number of entries.

    Documents meet in their band only, so a band has buckets of its own: a document's entries lie in few of them
    and share what is written once for them all.
    """
    band = F.size(F.filter(F.lit(LOWS.tolist()), lambda low: low <= F.col("n"))) - 1
    members = np.zeros(len(LOWS) + 1, dtype=np.int64)
    for row in classes.groupBy(band.alias("band")).agg(F.sum("n").alias("n")).collect():  # a row per band
        members[row["band"] : row["band"] + 2] += row["n"]  # a document may enter the next band too
    buckets = -(-members // (3 * BUCKET_ENTRIES))
    return np.cumsum(buckets) - buckets, buckets


def _packed_entries(words: int, begin: np.ndarray, dealt: np.ndarray):
    """Entries of every distinct set of a chunk, packed by bucket: keys of 48 bits, and the number of keys of each set."""
    names = ["bucket", "low", "high", "count", "cls", "band", "need"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, offsets, data in chunks(batch.column(0)):
                documents = len(offsets) - 1
                document, members = shingles(Words(offsets, data), documents, words)
                sizes, classes = class_hash(document, members, documents)
                _, first = np.unique(classes, return_index=True)
                fresh = np.zeros(documents, dtype=bool)
                fresh[first] = True
                kept = fresh[document]
                for owner, key, band, need in entries(document[kept], members[kept], np.where(fresh, sizes, 0)):
                    at = band % MEMBER_KEYS
                    bucket = begin[at] + ((key >> U64(32)) % dealt[at].astype(U64)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")  # sets come in order, and stay so within a bucket
                    owner, key, bucket = owner[order], key[order], bucket[order]
                    fresh_owner = np.ones(len(owner), dtype=bool)
                    fresh_owner[1:] = (owner[1:] != owner[:-1]) | (bucket[1:] != bucket[:-1])
                    head = np.flatnonzero(fresh_owner)
                    count = np.diff(np.append(head, len(owner)))
                    low, high = (key & U64(0xFFFFFFFF)).astype(np.uint32), ((key >> U64(32)) & U64(0xFFFF)).astype(np.uint16)
                    held = classes[owner[head]], band[order[head]].astype(np.uint8), need[order[head]].astype(np.int32)
                    used, cuts = np.unique(bucket, return_index=True)
                    cuts = np.append(cuts, len(bucket)).tolist()
                    heads = np.searchsorted(head, cuts).tolist()
                    rows = []
                    for i, b in enumerate(used.tolist()):
                        keys, sets = slice(cuts[i], cuts[i + 1]), slice(heads[i], heads[i + 1])
                        columns = low[keys], high[keys], count[sets].astype(np.int32), *(c[sets] for c in held)
                        rows.append((b, *(c.tobytes() for c in columns)))
                    columns = list(zip(*rows))
                    yield pa.record_batch(
                        [pa.array(columns[0], pa.int32())] + [pa.array(c, pa.binary()) for c in columns[1:]], names=names
                    )

    return run


_ENTRY = np.dtype([("key", "<u8"), ("cls", "<u8"), ("band", "u1"), ("need", "<i4"), ("known", "?"), ("told", "?")])


def _unpack(low: bytes, high: bytes, count: bytes, cls: bytes, band: bytes, need: bytes) -> np.ndarray:
    count = np.frombuffer(count, np.int32)
    ref = np.repeat(np.arange(len(count)), count)
    out = np.zeros(len(ref), dtype=_ENTRY)
    out["key"] = np.frombuffer(low, np.uint32).astype(U64) | (np.frombuffer(high, np.uint16).astype(U64) << U64(32))
    out["cls"] = np.frombuffer(cls, U64)[ref]
    out["band"] = np.frombuffer(band, np.uint8)[ref]
    out["need"] = np.frombuffer(need, np.int32)[ref]
    return out


def _fold(state: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One entry kept per key, and the entries of keys that several classes now share."""
    both = np.concatenate([state, new])
    both = both[np.argsort(both["key"], kind="stable")]  # what is known stays first
    first = np.ones(len(both), dtype=bool)
    first[1:] = both["key"][1:] != both["key"][:-1]
    at = np.flatnonzero(first)
    run = np.cumsum(first) - 1
    other = both["cls"] != both["cls"][at][run]
    shared = np.zeros(len(at), dtype=bool)
    shared[run[other]] = True
    kept = both[at]
    told = np.concatenate([kept[shared & ~kept["told"]], both[other]])
    kept["told"] |= shared
    kept["known"] = True
    if len(told):
        told = told[np.lexsort((told["cls"], told["key"]))]
        same = (told["key"][1:] == told["key"][:-1]) & (told["cls"][1:] == told["cls"][:-1])
        told = told[np.concatenate([[True], ~same])]
    return kept, told


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, cls, band, need) of keys held by several classes; buckets arrive one after another."""
    bucket, state, waiting, size = None, np.zeros(0, dtype=_ENTRY), [], 0

    def rows(told: np.ndarray) -> pa.RecordBatch:
        key = mix(told["key"] ^ mix(np.full(len(told), bucket, dtype=U64)))
        return pa.record_batch(
            [
                pa.array(key.view(np.int64)),
                pa.array(np.ascontiguousarray(told["cls"]).view(np.int64)),
                pa.array(told["band"].astype(np.int32)),
                pa.array(told["need"].astype(np.int32)),
            ],
            names=["key", "cls", "band", "need"],
        )

    for batch in batches:
        for b, *packed in zip(*[batch.column(i).to_pylist() for i in range(7)]):
            if b != bucket or size >= FOLD_ENTRIES:
                if waiting:
                    state, told = _fold(state, np.concatenate(waiting))
                    if len(told):
                        yield rows(told)
                waiting, size = [], 0
                if b != bucket:
                    bucket, state = b, np.zeros(0, dtype=_ENTRY)
            waiting.append(_unpack(*packed))
            size += len(waiting[-1])
    if waiting:
        _, told = _fold(state, np.concatenate(waiting))
        if len(told):
            yield rows(told)


def _members(words: int):
    """(cls, members) of documents whose set is the wanted class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for row, offsets, data in chunks(batch.column(0)):
                documents = len(offsets) - 1
                document, members = shingles(Words(offsets, data), documents, words)
                _, classes = class_hash(document, members, documents)
                cut = np.searchsorted(document, np.arange(documents + 1))
                hit = np.flatnonzero(classes.view(np.int64) == wanted[row : row + documents])
                yield pa.record_batch(
                    [
                        pa.array(classes.view(np.int64)[hit]),
                        pa.array([members[cut[i] : cut[i + 1]].tobytes() for i in hit.tolist()], pa.binary()),
                    ],
                    names=["cls", "members"],
                )

    return run


def _fetched(hashed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(text, cls): the text that stands for each wanted class, in as many copies as there are rows equal in id and text."""
    return hashed.join(wanted, hashed["id"].eqNullSafe(wanted["id"]) & (hashed["th"] == wanted["th"])).select("text", "cls")


def _rarest(shared: DataFrame) -> DataFrame:
    """(key, cls, band): the keys under which a class meets others, all but its ``need - 1`` commonest.

    Keys have one order, by the number of rows that hold them. A class with fewer than ``need`` shared keys
    meets nothing. A key and class that come twice are one.
    """
    held = F.count(F.lit(1)).over(Window.partitionBy("key"))
    commonest = Window.partitionBy("cls", "band").orderBy(F.desc("held"), F.desc("key"))
    ranked = shared.withColumn("held", held).withColumn("place", F.dense_rank().over(commonest))
    return ranked.where("place >= need").select("key", "cls", "band")


def _bits(members: list[np.ndarray], width: int) -> np.ndarray:
    """Dense bit sketches: every member flips one of ``width`` bits."""
    sizes = np.array([len(m) for m in members])
    owner = np.repeat(np.arange(len(members)), sizes)
    flat = np.concatenate(members)
    place = (mix(flat ^ _BIT_SEED) % U64(width)).astype(np.int64)
    parity = (np.bincount(owner * width + place, minlength=len(members) * width) & 1).astype(np.uint8)
    return np.packbits(parity.reshape(len(members), width), axis=1).view(U64)


def _is_short(members: np.ndarray, band: int) -> bool:
    """Whether the document entered the band under its members too."""
    sizes = np.array([len(members)])
    bands = np.array([band])
    _, _, empty = _sketch(np.zeros(len(members), dtype=np.int64), members, bands)
    return bool(PLACES[band] - _most_apart(sizes, bands)[0] - empty[0] <= 0)


def _compare(group: pa.Table) -> pa.Table:
    """Links of one pair of blocks: (u, v, links) with a spanning forest and each class's number of links.

    A pair is judged in one band only, that of its larger set, and under members
    only where both documents are short of places.
    """
    band = group.column("band")[0].as_py()
    under_members, band = band >= MEMBER_KEYS, band % MEMBER_KEYS
    first, second = group.column("bi")[0].as_py(), group.column("bj")[0].as_py()
    cls = group.column("cls").to_numpy()
    copies = group.column("copies").to_numpy()
    block = group.column("block").to_numpy()
    members = [np.frombuffer(m, dtype=U64) for m in group.column("members").to_pylist()]
    sizes = np.array([len(m) for m in members])
    short = np.array([_is_short(m, band) for m in members])
    width = -(-4 * int(HIGHS[band]) // 64) * 64
    bits = np.concatenate([_bits(members[i : i + 64], width) for i in range(0, len(members), 64)])
    own = band_of(sizes) == band
    left = np.flatnonzero(block == first)
    right = left if first == second else np.flatnonzero(block == second)
    links = np.zeros(len(cls), dtype=np.int64)
    parent = list(range(len(cls)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest = []
    for at, i in enumerate(left.tolist()):
        others = right[at + 1 :] if first == second else right
        both = sizes[others] + sizes[i]
        fits = 10 * np.minimum(sizes[others], sizes[i]) >= 8 * np.maximum(sizes[others], sizes[i])
        fits &= own[others] | own[i]
        fits &= (short[others] & short[i]) == under_members
        others, both = others[fits], both[fits]
        if not len(others):
            continue
        apart = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1, dtype=np.int64)
        near = 9 * apart <= both
        others, both = others[near], both[near]
        if not len(others):
            continue
        flat = np.concatenate([members[j] for j in others.tolist()])
        spot = np.minimum(np.searchsorted(members[i], flat), sizes[i] - 1)
        hits = (members[i][spot] == flat).astype(np.int64)
        common = np.add.reduceat(hits, np.cumsum(sizes[others]) - sizes[others])
        for j in others[100 * common >= 80 * (both - common)].tolist():
            links[i] += copies[j]
            links[j] += copies[i]
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                forest.append((i, j))
    counted = np.flatnonzero(links)
    u = np.concatenate([cls[[i for i, _ in forest]], cls[counted]]).astype(np.int64)
    v = np.concatenate([cls[[j for _, j in forest]], cls[counted]]).astype(np.int64)
    n = np.concatenate([np.zeros(len(forest), dtype=np.int64), links[counted]])
    return pa.table({"u": u, "v": v, "links": n})


def jaccard_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 5, row_column: str | None = None,
    group_column: str | None = None,
) -> DataFrame:
    """One row per document: its id, n_shingles, component_id and n_links.

    ``component_id`` is the smallest id reachable by links, ``n_links`` the number
    of documents linked with this one directly, copies included. A long
    ``row_column`` that tells rows of one id apart is handed through.
    ``component_id`` does not tell groups apart whose ids are all null or whose
    smallest ids are equal; ``group_column`` adds a key that does, null for empty texts.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))

    named_rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(text_column).cast("string").alias("text"),
        *([] if row_column is None else [F.col(row_column).alias("row")]),
    ).withColumn("th", F.xxhash64("text"))
    shape = "id long, th long, n long, cls long" if row_column is None else "id long, row long, th long, n long, cls long"
    sets = scratch.store(named_rows.mapInArrow(_summaries(words), shape), "sets")
    classes = scratch.store(
        sets.where("n > 0").groupBy("cls").agg(
            F.min("id").alias("least"), F.min(F.struct("id", "th")).alias("at"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n")
        ),
        "classes",
    )
    begin, dealt = _dealt(classes)
    packed = source.select("text").mapInArrow(
        _packed_entries(words, begin, dealt),
        "bucket int, low binary, high binary, count binary, cls binary, band binary, need binary",
    )
    shared = scratch.store(
        packed.repartition(max(1, int(dealt.sum())), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_shared_keys, "key long, cls long, band int, need int"),
        "shared",
    )
    meeting = scratch.store(_rarest(shared), "meeting")
    scratch.drop(shared)
    hubs = meeting.groupBy("key").agg(F.min("cls").alias("hub"), F.max("cls").alias("top")).where("hub < top")
    node = lambda c: F.xxhash64("band", c)
    spokes = scratch.store(
        meeting.join(hubs, "key").where("cls <> hub").select("band", "cls", "hub").distinct(), "spokes"
    )
    groups = components(scratch, spokes.select(node("cls").alias("u"), node("hub").alias("v")))
    candidates = (
        spokes.select("band", "cls")
        .union(spokes.select("band", F.col("hub").alias("cls")))
        .distinct()
        .withColumn("node", node("cls"))
        .join(groups, "node")
        .join(classes, "cls")
        .select("band", "cls", F.col("label").alias("grp"), "copies", "n", "at")
    )
    candidates = scratch.store(candidates, "candidates")
    blocks = candidates.groupBy("band", "grp").agg(F.sum("n").alias("weight"), F.count(F.lit(1)).alias("size"))
    blocks = blocks.where("size > 1").select(
        "band", "grp", F.ceil(F.col("weight") / F.lit(BLOCK_MEMBERS)).cast("int").alias("blocks")
    )

    # by id and text: many rows can have one id, or none, and each would meet every class of that id
    wanted = candidates.select("at.id", "at.th", "cls").distinct()
    if wanted.count() <= BROADCAST_ROWS:  # 24 bytes a row; beyond that the join shuffles
        wanted = F.broadcast(wanted)
    fetched = _fetched(source.withColumn("th", F.xxhash64("text")), wanted)
    members = fetched.mapInArrow(_members(words), "cls long, members binary").dropDuplicates(["cls"])

    placed = candidates.join(blocks, ["band", "grp"]).withColumn("block", F.expr("int(pmod(xxhash64(cls), blocks))"))
    pairs = placed.select(
        "band", "grp", "cls", "copies", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("band", "grp", "cls", "copies", "block", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"))
    found = scratch.store(
        pairs.join(members, "cls")
        .groupBy("band", "grp", "bi", "bj")
        .applyInArrow(_compare, "u long, v long, links long"),
        "found",
    )

    counted = found.groupBy(F.col("u").alias("cls")).agg(F.sum("links").alias("linked"))
    named = components(scratch, found.where("links = 0").select("u", "v"))
    least = named.join(classes, named["node"] == classes["cls"]).groupBy("label").agg(F.min("least").alias("component"))
    named = named.join(least, "label").select(F.col("node").alias("cls"), "component", "label")
    answer = (
        classes.join(named, "cls", "left")
        .join(counted, "cls", "left")
        .select(
            "cls",
            F.coalesce("component", "least").alias("component_id"),
            F.coalesce("label", "cls").alias("group"),
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        )
    )
    answer = scratch.store(answer, "answer")  # a class can hold a third of all documents: then its join can be split
    return sets.join(answer, "cls", "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        *([] if row_column is None else [F.col("row").alias(row_column)]),
        *([] if group_column is None else [F.col("group").alias(group_column)]),
    )
