"""Spelling variants, periodic runs and WARC bundles against brute force, and their defined edge cases."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vaultspan.llm import periodic_runs, queries, spelling, warc_bundles
from vaultspan.llm.run_grammar import RunGrammar
from vaultspan.llm.scratch import Scratch

FOLDER = "/root/testdata/sf0.001"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture
def stored(tmp_path):
    """A folder of tables as the queries read them."""

    def store(**tables):
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return store


# op11


def brute_words(rows) -> collections.Counter:
    words = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return collections.Counter({w: n for w, n in words.items() if len(w) >= 7 and n >= 2})


def brute_variants(words) -> dict:
    """Near words share the word or the word less a letter; by definition checked after that."""
    by_gap = collections.defaultdict(set)
    for word in words:
        for k in range(len(word)):
            by_gap[len(word), k, word[:k] + word[k + 1 :]].add(word)
    near = collections.defaultdict(set)
    for group in by_gap.values():
        for word in group:
            near[word] |= group - {word}
    for word in words:
        for k in range(len(word)):
            shorter = word[:k] + word[k + 1 :]
            if shorter in words:
                near[word].add(shorter)
                near[shorter].add(word)
    out, forms = {}, {}
    for word, n in words.items():
        best = min(near[word], key=lambda w: (-words[w], w), default=None)
        if best is not None and words[best] >= 10 * n:
            forms[word] = best
    for word, n in words.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        out[word] = (form, root, n, len(near[word]), words[form] if form else None)
    return out


def spelled(rows) -> dict:
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows.collect()}


def test_the_query_equals_brute_force(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    found = queries.queries()["op11_spelling"](spark, FOLDER)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute_variants(brute_words(rows))
    assert spelled(found) == expected and len(expected) > 500
    assert any(form for form, *_ in expected.values())


def made_words(seed: int, size: int) -> list[str]:
    pick = random.Random(seed)
    words = {"".join(pick.choice("abcdéàÿ") for _ in range(pick.randint(7, 9))) for _ in range(size)}
    for word in list(words):
        k = pick.randrange(len(word))
        words |= {word[:k] + word[k + 1 :], word[:k] + "z" + word[k:], word[:k] + "e" + word[k + 1 :]}
    return sorted(w for w in words if len(w) >= 7)


@pytest.mark.parametrize("groups, chunk, slot", [((2,), 1 << 20, 1 << 20), ((5,), 200, 500), ((3,), 64, 100), ((8,), 1 << 20, 1 << 20)])
def test_any_blocks_chunks_and_slots_give_the_same(spark, monkeypatch, groups, chunk, slot):
    """Full blocks are cut; every pair is still met once."""
    monkeypatch.setattr(spelling, "GROUPS", groups)
    monkeypatch.setattr(spelling, "BLOCK_BYTES", chunk)
    monkeypatch.setattr(spelling, "SLOT_BYTES", slot)
    pick = random.Random(3)
    counts = {w: pick.choice([1, 2, 2, 3, 25, 400]) for w in made_words(1, 250)}
    rows = spark.createDataFrame([(w, n) for w, n in counts.items()], "word string, n int")
    rows = rows.select("word", F.explode(F.sequence(F.lit(1), "n")))
    kept = collections.Counter({w: n for w, n in counts.items() if n >= 2})
    assert spelled(spelling.variants(Scratch(spark, "t"), rows.select("word"))) == brute_variants(kept)


def test_forms_are_followed_to_the_root(spark):
    chain = {"abcdefgh": 2, "abcdefghi": 20, "abcdefghij": 200, "abcdefghijk": 2000, "abcdefghijkl": 20000}
    rows = spark.createDataFrame(list(chain.items()), "word string, n int").select("word", F.explode(F.sequence(F.lit(1), "n")))
    found = spelled(spelling.variants(Scratch(spark, "t"), rows.select("word")))
    assert {found[w][1] for w in chain} == {"abcdefghijkl"}
    assert found["abcdefgh"][0] == "abcdefghi" and found["abcdefghijkl"][0] is None


def test_very_long_words_and_ties(spark):
    long = "ab" * 3000
    words = [long, long[:-1], long[:1500] + "c" + long[1501:], "tiestxa", "tiestxb", "tiestxc"]
    counts = [2, 20, 20, 2, 30, 30]
    rows = spark.createDataFrame(list(zip(words, counts)), "word string, n int").select("word", F.explode(F.sequence(F.lit(1), "n")))
    found = spelled(spelling.variants(Scratch(spark, "t"), rows.select("word")))
    assert found == brute_variants(collections.Counter(dict(zip(words, counts))))
    assert found["tiestxa"][0] == "tiestxb" and found[long][0] == min(words[1], words[2])


def test_spelling_of_awkward_tables(spark, awkward, nothing, stored):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    folder = stored(documents=awkward.withColumn("word", F.lit("clash")).withColumn("n", F.lit(3)))
    assert spelled(queries.queries()["op11_spelling"](spark, folder)) == brute_variants(brute_words(rows))
    assert queries.queries()["op11_spelling"](spark, stored(documents=nothing)).count() == 0


# op12


def brute_runs(words: list, least: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
    found = {}
    for period in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words) - period:
            j = i
            while j < len(words) - period and words[j] == words[j + period]:
                j += 1
            if j - i + period >= max(least, exponent * period):
                found.setdefault((i, j - i + period), period)
            i = j + 1
    return sorted((start, length, period) for (start, length), period in found.items())


def brute_answer(key: int | None, text: str | None) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if key is not None and words:
        h = zlib.crc32(str(key).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {k for start, length, period in runs for k in range(start + period, start + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (
        key, len(runs), *first, digest("".join(f"{s},{n},{p}\n" for s, n, p in runs)),
        digest(" ".join(w for k, w in enumerate(words) if k not in dropped)),
    )


COLUMNS12 = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_of_the_query_equal_brute_force(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    found = queries.queries()["op12_periodic_runs"](spark, FOLDER).select(COLUMNS12).collect()
    expected = collections.Counter(brute_answer(*row) for row in rows)
    assert collections.Counter(tuple(r) for r in found) == expected
    assert sum(r["n_runs"] > 0 for r in found) > 5


def test_runs_of_awkward_tables(spark, awkward, nothing, stored):
    repeated = [(20, "a b " * 4000 + "c", "en", "a", 1, 0), (21, "x " * 50_000, "en", "a", 1, 0), (22, "a b a b\x1fc", "en", "a", 1, 0)]
    more = awkward.unionByName(spark.createDataFrame(repeated, awkward.schema)).withColumn("runs", F.lit("clash")).withColumn("row", F.lit(1))
    rows = [(r["doc_id"], r["text"]) for r in more.collect()]
    found = queries.queries()["op12_periodic_runs"](spark, stored(documents=more)).select(COLUMNS12).collect()
    assert collections.Counter(tuple(r) for r in found) == collections.Counter(brute_answer(*row) for row in rows)
    assert queries.queries()["op12_periodic_runs"](spark, stored(documents=nothing)).count() == 0
    kept = periodic_runs.periodic_runs(more.withColumn("n_words", F.lit(-1)), runs_column="found")
    assert {"runs", "row", "lang"} <= set(kept.columns) and kept.where("runs = 'clash'").count() == len(rows)


sequences = st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=6)


@given(sequences, st.sampled_from([(6, 4), (2, 2), (3, 3), (1, 5)]))
@settings(max_examples=150, deadline=None)
def test_runs_of_short_alphabets(texts, rule):
    symbols, counts = np.array([w for t in texts for w in t], dtype=np.int64), np.array([len(t) for t in texts], dtype=np.int64)
    found = sorted(zip(*[c.tolist() for c in periodic_runs.find_runs(symbols, counts, *rule)]))
    assert found == sorted((k, *run) for k, t in enumerate(texts) for run in brute_runs(t, *rule))


@given(st.lists(st.integers(0, 1), min_size=2, max_size=300), st.data())
@settings(max_examples=100, deadline=None)
def test_extensions_of_the_grammar(word, data):
    grammar = RunGrammar(np.array([-1, *word, -2], dtype=np.int64))
    i, j = sorted(data.draw(st.lists(st.integers(1, len(word)), min_size=2, max_size=2, unique=True)))
    ahead = next((k for k in range(len(word)) if j + k > len(word) or word[i + k - 1] != word[j + k - 1]), None)
    behind = next(k for k in range(len(word) + 1) if i - 1 - k < 1 or word[i - 2 - k] != word[j - 2 - k])
    assert grammar.forward(np.array([i]), np.array([j]))[0] == ahead
    assert grammar.backward(np.array([i]), np.array([j]))[0] == behind


# op13


def brute_pages(rows) -> collections.Counter:
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    seen, out = {}, collections.Counter()
    for key, _, html in rows:
        payload = (html or "").encode()
        again = len(payload) >= 1000 and payload in seen
        refers = seen[payload] if again else None
        seen.setdefault(payload, key)
        out[(key, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", refers)] += 1
    return out


def test_archived_pages_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url", "html").collect()]
    found = queries.queries()["op13_warc"](spark, FOLDER)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert collections.Counter(tuple(r) for r in found.collect()) == brute_pages(rows)


@pytest.fixture(scope="module")
def pages(spark):
    big, same = "é<p>" * 400, "x" * 1000
    rows = [
        (1, "http://a/1", big, 1), (9, "http://a/9", big, 2), (9, "http://a/9", big, 3), (4, None, big, 4),
        (5, "http://b\r\nX: 1", same, 5), (None, None, same, 6), (None, None, same, 6), (7, "u", same[:-1], 7), (8, "u", same[:-1], 8),
        (10, "u", None, 9), (11, "", "", 10), (None, None, None, 11), (12, "u", "line\r\n\r\nline\r\n", 12),
        (13, "u", "WARC/1.1\r\n\r\n" * 100_000, 13),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload int")


def test_awkward_pages(spark, pages, stored):
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    found = queries.queries()["op13_warc"](spark, stored(pages=pages))
    assert collections.Counter(tuple(r) for r in found.collect()) == brute_pages(rows)
    assert queries.queries()["op13_warc"](spark, stored(pages=pages.where("false"))).count() == 0


def test_bundles_are_plain_zstandard_and_their_frames_stand_alone(spark, pages, tmp_path):
    index = warc_bundles.write_bundles(Scratch(spark, "t"), pages, folder=str(tmp_path / "kept"), frame_bytes=3000)
    rows = index.collect()
    assert len({r["record_id"] for r in rows}) == len(rows) == pages.count()
    for name in {r["bundle"] for r in rows}:
        with open(name, "rb") as file:
            whole = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
        opened = warc_bundles.Bundle(name)
        frames = [opened.frame(k) for k in range(len(opened))]
        assert b"".join(frames) == whole
        starts = np.cumsum([0, *map(len, frames)])
        for r in (r for r in rows if r["bundle"] == name):
            at = starts[r["frame"]] + r["offset"]
            fields, _ = warc_bundles.parse(whole[at : at + r["length"]])
            assert fields["warc-record-id"] == r["record_id"] and fields["warc-type"] == r["record_type"]
    assert max(r["frame"] for r in rows) > 0


def test_some_records_are_read_alone(spark, pages, tmp_path):
    index = warc_bundles.write_bundles(Scratch(spark, "t"), pages, folder=str(tmp_path / "kept"))
    records = warc_bundles.read_records(index.where("page_id in (12, 13)")).collect()
    assert {r["page_id"]: bytes(r["payload"]) for r in records} == {12: b"line\r\n\r\nline\r\n", 13: b"WARC/1.1\r\n\r\n" * 100_000}


def test_a_damaged_frame_is_refused(tmp_path):
    place = str(tmp_path / "b.warc.zst")
    writer = warc_bundles.BundleWriter(pa.OSFile(place, "wb"))
    writer.add(b"one record")
    writer.close()
    data = bytearray(open(place, "rb").read())
    data[8] ^= 1
    open(place, "wb").write(data)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        warc_bundles.Bundle(place).frame(0)
