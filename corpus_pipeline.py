"""A corpus pipeline of five stages, each by one operator of vaultspan.llm.

toxicity        documents scored 0.7 or more go
near duplicates of each group of similar documents the one with the smallest id stays
secrets         found spans are replaced by a mark, n_chars follows; no document goes
mixing          a document appears once per pass that the mixture takes of it
tokens          byte-level BPE ids of every remaining text; the result

Null texts and ids, empty texts, repeated rows and empty tables pass through every
stage as the operators define: an empty text is harmless, similar to nothing, without
secrets, has no words and is therefore never taken by the mixture. Columns beyond
those of ``documents`` are dropped at the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspan.llm import byte_bpe, mixing, parity_join, secret_scan, toxicity
from vaultspan.llm.queries import ship
from vaultspan.llm.scratch import Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = docs.select(*COLUMNS)
    machine = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, machine, column="_score").where(F.col("_score") < TOXIC).drop("_score")


def _row() -> Column:
    """Tells the documents of one id apart, so the key is (doc_id, this); rows equal in both are one document."""
    return F.xxhash64("text")


def _keyed(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Documents joined with rows that carry their key; a null id is an id like any other."""
    other = rows.withColumnsRenamed({"doc_id": "_id", "_row": "_other"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_other"))
    return docs.dropDuplicates(["doc_id", "_row"]).join(other, same)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group the document whose id names it stays, and documents that are similar to none."""
    ship(spark)
    docs = docs.select(*COLUMNS).withColumn("_row", _row())
    named = parity_join.jaccard_components(
        docs.select("doc_id", "text", "_row"), row_column="_row", group_column="_group"
    ).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    alone = named.where("n_links = 0").select("doc_id", "_row")
    # several rows can carry the id that names the group, and several groups can have that name
    first = named.where("n_links > 0").groupBy("_group").agg(F.min(F.struct("doc_id", "_row")).alias("f")).select("f.*")
    return _keyed(docs, alone.union(first).distinct()).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(docs.select(*COLUMNS), column="_spans")
    clean = F.size("_spans") == 0
    text = secret_scan.redacted(F.col("text"), F.col("_spans"))
    return found.select(
        "doc_id",
        text.alias("text"),
        "lang",
        "source",
        F.when(clean, F.col("n_chars")).otherwise(F.length(text).cast("long")).alias("n_chars"),
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in training order, one per pass; a pass that is cut short counts as a whole one."""
    ship(spark)
    docs = docs.select(*COLUMNS).withColumn("_row", _row())
    passes = mixing.mix(docs, row_column="_row").select("doc_id", "_row", F.explode("positions").alias("_position"))
    joined = _keyed(docs, passes)
    return joined.repartitionByRange("_position").sortWithinPartitions("_position").select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode(docs, path, public_tokenizers.PATTERN).select("doc_id", "source", "n_chars", "n_tokens", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]

#: The learned scores of the first stage cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written and read again, as the next one's input."""
    scratch = Scratch(spark, "pipeline")
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
        if last is not None:
            scratch.drop(last)
        last = docs
    return docs
