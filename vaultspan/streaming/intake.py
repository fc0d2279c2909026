"""Fact extracts that arrive as files, staged insert-only as a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vaultspan.plans.staging import Run, StagedFact, stage_new_rows
from vaultspan.sources.schemas import RawTable

_UNKEYED = "_unkeyed"

# Spark's own settings. Keys seen lie in RocksDB on the executors, and a micro-batch
# uploads only what it changed, so a checkpoint grows with the new keys and not with all keys.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for what is started inside; a stream keeps a copy of those it started with."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def batch_name(batch_id: int) -> str:
    return f"b{batch_id:012d}"


def unseen_keys(arriving: DataFrame, key: str) -> DataFrame:
    """The first row of every key of a stream of files, by the keys kept in the state store.

    A key has one place in the state whatever micro-batch brings it, so the rows kept do not depend
    on how arrivals are cut into batches. Rows without a key are no repeats of each other: each is
    known by its place in its file, which also spreads them over the state's partitions.
    """
    place = F.concat_ws(" ", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))
    marked = arriving.select("*", F.when(F.col(key).isNull(), place).alias(_UNKEYED))
    return marked.dropDuplicates([key, _UNKEYED]).drop(_UNKEYED)


def intake(
    spark: SparkSession, arrivals: str, table: RawTable, path: str, checkpoint: str, run_ts: datetime
) -> StreamingQuery:
    """Stage every Parquet extract below ``arrivals`` not seen yet, then stop.

    Each micro-batch is one load of the staged table. The keys of earlier loads are in the state
    store, so no earlier load is read. A repeated micro-batch starts from the state before it, has
    the same number and replaces its own folder and index, so rows and ids come out once. Of rows
    with one key the first that arrives counts; rows without a key only count in the first
    micro-batch, as in a batch load. A table that holds later loads than the checkpoint knows of is
    refused: its keys are not in the state.
    """
    staged = StagedFact(spark, path, table)

    def stage(batch: DataFrame, batch_id: int) -> None:
        run, known = Run(batch_name(batch_id), run_ts), staged.index.loads()
        if any(load > run.run_id for load in known):
            raise ValueError(f"{path} holds loads after {run.run_id}: the checkpoint {checkpoint} is not the one that made it")
        earlier = [load for load in known if load < run.run_id]
        fresh = batch.where(F.col(table.key).isNotNull()) if batch_id else batch
        rows = stage_new_rows(fresh, table, run, after=staged.index.highest_id(earlier))
        staged.index.add(run.run_id, staged.store.write(run.run_id, rows))

    stream = spark.readStream.schema(table.schema).parquet(arrivals)
    writer = unseen_keys(stream, table.key).writeStream.foreachBatch(stage)
    with _set(spark, _STATE):
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
