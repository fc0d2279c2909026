from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

import bank
from vaultspan.plans.staging import Run, stage_new_rows
from vaultspan.sources.files import LoadedTable
from vaultspan.sources.schemas import FACTS
from vaultspan.streaming.intake import batch_name, intake

TABLE = FACTS["fct_ope"]
TS = datetime(2024, 3, 1)
NO_KEY = (None, *bank.OPERATIONS[0][1:])
FOURTH = bank.operation(4, "P2", bank.D(2022, 2, 22), "USD", "75")


class Feed:
    def __init__(self, spark, root):
        self.spark = spark
        self.arrivals, self.path, self.checkpoint = (str(root / n) for n in ("in", "staged", "checkpoint"))

    def run(self, checkpoint=None):
        """Start a stream on what has arrived and wait until it has stopped."""
        intake(self.spark, self.arrivals, TABLE, self.path, checkpoint or self.checkpoint, TS).awaitTermination()

    def arrive(self, rows):
        bank.raw(self.spark, "fct_ope", rows).coalesce(1).write.mode("append").parquet(self.arrivals)
        self.run()

    def load(self, number):
        return LoadedTable(self.spark, self.path).read([batch_name(number)])


def listed(df):
    return sorted(((int(r["id_stg_fct_ope"]), r["cd_fct_ope"], r["mt_ope"], r["cd_pid"]) for r in df.collect()), key=str)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_loads_equal_the_batch_load_and_no_earlier_one_is_read(spark, feed):
    arrivals = [bank.OPERATIONS[:2] + [NO_KEY, NO_KEY], [*bank.OPERATIONS, NO_KEY], [*bank.OPERATIONS, FOURTH]]
    held = None
    for number, rows in enumerate(arrivals):
        feed.arrive(rows)  # every call is a restart
        expected = stage_new_rows(bank.raw(spark, "fct_ope", rows), TABLE, Run(batch_name(number), TS), held)
        assert listed(feed.load(number)) == listed(expected)
        held = expected if held is None else held.unionByName(expected)
        held = spark.createDataFrame(held.collect(), held.schema)
        for file in Path(feed.path, f"load={batch_name(number)}").glob("*.parquet"):
            file.write_bytes(b"not to be read again")
    feed.run()  # nothing has arrived
    assert len(LoadedTable(spark, f"{feed.path}_key_summaries").loads()) == 3


def test_a_failed_micro_batch_is_repeated_from_the_state_before_it(feed, monkeypatch):
    feed.arrive(bank.OPERATIONS[:1])
    from vaultspan.sources.key_index import KeyIndex

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(KeyIndex, "add", broken)
        with pytest.raises(StreamingQueryException, match="lost"):
            feed.arrive(bank.OPERATIONS)
    feed.run()
    assert [(i, key) for i, key, *_ in listed(feed.load(1))] == [(2, "OPE-2"), (3, "OPE-3")]


def test_a_repeated_key_counts_once(feed):
    feed.arrive([bank.OPERATIONS[0], bank.OPERATIONS[0], bank.OPERATIONS[1]])
    assert [(i, key) for i, key, *_ in listed(feed.load(0))] == [(1, "OPE-1"), (2, "OPE-2")]


def test_a_strange_checkpoint_is_refused(feed):
    for last in (1, 2, 3):
        feed.arrive(bank.OPERATIONS[:last])
    with pytest.raises(StreamingQueryException, match="checkpoint"):
        feed.run(feed.checkpoint + "-other")
