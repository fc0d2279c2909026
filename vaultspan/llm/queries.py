"""One query per operator over its whole table, and the pipeline."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspan.llm import (
    byte_bpe,
    lattice_search,
    mixing,
    parity_join,
    periodic_runs,
    repeated_spans,
    secret_scan,
    sharding,
    spelling,
    token_files,
    toxicity,
    tree_forest,
    warc_bundles,
)
from vaultspan.llm.oracles import oracle_sql as oracle_sql
from vaultspan.llm.scratch import Scratch

LONG_WORD = 7

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python workers, once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        # the driver's own folder; Spark itself serves the archive to the executors
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/vaultspan", "zip", Path(__file__).parents[2], "vaultspan")
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return parity_join.jaccard_components(_table(spark, folder, "documents"))


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, folder, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digest(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    index = token_files.write_token_files(Scratch(spark, "token-files"), _table(spark, folder, "documents"), path, end_id=2)
    return token_files.read_token_files(index).withColumnRenamed("id", "doc_id")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    machine = toxicity.fit(docs, _table(spark, folder, "labels"))
    rows = docs.select("doc_id", "text", toxicity.is_held_out(F.col("doc_id")).alias("held_out"))
    return toxicity.score(rows, machine).select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )


def op6_suffix_sort(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = repeated_spans.remove_repeats(_table(spark, folder, "documents"), length=200)
    return cleaned.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, folder, "documents"))
    ordered = mixed.withColumn("first_position", F.get("positions", F.lit(0))).withColumn("passes", F.size("positions"))
    return ordered.repartitionByRange(F.asc_nulls_last("first_position"), "doc_id").select(
        "doc_id", "size", "source_size", "target", "taken", "passes", "first_position"
    )


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(_table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("secret_spans")
    of_kind = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[of_kind(k).alias(f"n_{name}") for k, name in enumerate(secret_scan.BASE_KINDS)],
        F.sha2(secret_scan.printed(secret_scan.base_spans(spans)), 256).alias("base_sha256"),
        secret_scan.printed(spans).alias("spans"),
    )


def op9_lattice_search(spark: SparkSession, folder: str) -> DataFrame:
    return lattice_search.nearest_neighbours(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op10_tree_forest(spark: SparkSession, folder: str) -> DataFrame:
    return tree_forest.near_vectors(_table(spark, folder, "embeddings"), threshold=0.98)


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Words of whole texts; every 31st pair of document and run, by checksum, loses a letter first. A null id prints as nothing."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    runs = spelling.occurrences(docs, least=LONG_WORD)
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
    marked = runs.select("word", F.crc32(named.cast("binary")).alias("h"))
    place = (F.col("h") % F.length("word")).cast("int")
    words = marked.select(F.when(F.col("h") % 31 == 0, spelling.without_letter(F.col("word"), place)).otherwise(F.col("word")).alias("word"))
    return spelling.variants(Scratch(spark, "spelling"), words, least_length=LONG_WORD).select("word", "form", "root", "n", "n_near", "form_n")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Texts of every tenth document, by checksum of its id, go on from some word by repeating what follows it; a null id stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.call_function("div", h, F.lit(10).cast("long"))
    one = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)

    def planted(words):
        n = F.size(words)

        def repeat(at):
            period = F.lit(1) + F.floor((n - at) / (F.lit(3) + g % 8))
            return one(period, lambda p: F.array_join(F.transform(words, lambda w, i: F.when(i < at, w).otherwise(F.get(words, (at + (i - at) % p).cast("int")))), " "))

        return F.when(n > 0, one((g % n).cast("int"), repeat)).otherwise(F.col("text"))

    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return docs.select("doc_id", F.when(h % 10 == 0, one(words, planted)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_runs(_table(spark, folder, "documents")))
    runs = F.col("runs")
    # longest first, then smallest start and period
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select("doc_id", "n_words", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"),
        F.call_function("div", -F.col("best.l") * 1000, F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    index = warc_bundles.write_bundles(scratch, _table(spark, folder, "pages"))
    records = warc_bundles.read_records(index, payloads=False)
    return warc_bundles.resolved(scratch, records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_QUERIES = (
    op1_ngram_jaccard,
    op2_sharding,
    op3_byte_bpe,
    op4_token_files,
    op5_toxicity,
    op6_suffix_sort,
    op7_mixing,
    op8_secret_scan,
    op9_lattice_search,
    op10_tree_forest,
    op11_spelling,
    op12_periodic_runs,
    op13_warc,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipping(query):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return query(spark, folder)

        return run

    return {query.__name__: shipping(query) for query in _QUERIES}
