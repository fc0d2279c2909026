"""CSV extracts, append-only and versioned Parquet state, clustered marts."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vaultspan.sources.schemas import RawTable

LOAD = "load"


def read_extract(spark: SparkSession, path: str, table: RawTable) -> DataFrame:
    """A raw CSV extract: header in any case, comma, UTF-8, empty field = NULL."""
    upper = StructType.fromDDL(
        ", ".join(f"{f.name.upper()} {f.dataType.simpleString()}" for f in table.schema)
    )
    raw = (
        spark.read.schema(upper)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return raw.toDF(*table.columns)


def write_extract(df: DataFrame, path: str) -> None:
    """Write a raw table the way ``read_extract`` expects it, replacing the folder."""
    df.toDF(*(c.upper() for c in df.columns)).write.mode("overwrite").option("header", True).csv(path)


class LoadedTable:
    """A table kept as one Parquet folder per load, ``<path>/load=<id>``.

    A load only ever writes its own folder, so a retry never touches a file it
    reads. Which loads count is the caller's decision. Ids are plain text.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def _folder(self, load: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9._-]+", load):
            raise ValueError(f"load id {load!r} must consist of letters, digits, dots, dashes and underscores")
        return f"{self.path}/{LOAD}={load}"

    def read(self, loads: Sequence[str], schema: StructType | None = None) -> DataFrame | None:
        """The rows of the given loads, None when there are no loads.

        Loads written with ``split`` need the ``schema``, as a load without
        rows leaves no file that would tell it.
        """
        if not loads:
            return None
        folders = [self._folder(load) for load in loads]
        if schema is None:
            return self.spark.read.parquet(*folders)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders).select(*schema.names)

    def read_parts(self, split: str, parts: Sequence[tuple[str, str]], schema: StructType) -> DataFrame | None:
        """The rows of some (load, value of ``split``) folders, None when there are none."""
        if not parts:
            return None
        folders = [f"{self._folder(load)}/{split}={value}" for load, value in parts]
        return self.spark.read.schema(schema).parquet(*folders)

    def write(
        self,
        load: str,
        rows: DataFrame,
        by: Sequence[str | Column] = (),
        split: str | None = None,
        watch: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """Write one load, clustered on ``by`` if given, in a folder per value of ``split``; read it back.

        ``watch`` may observe the rows as they are written; it must hand them on unchanged.
        """
        laid = clustered(rows, by) if by else rows
        writer = (watch(laid) if watch else laid).write.mode("overwrite")
        (writer.partitionBy(split) if split else writer).parquet(self._folder(load))
        return self.read([load], rows.schema if split else None)

    def loads(self) -> list[str]:
        """All load ids in the folder, in order. Meant for small tables."""
        try:
            # a given type keeps ids like 001 and 1e3 from being read as numbers
            found = self.spark.read.schema(f"{LOAD} string").parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted(row[0] for row in found.distinct().collect())


def clustered(df: DataFrame, by: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort on ``by``.

    A hash of the row is the last range column, so a value of ``by`` that holds
    a large share of the rows is spread over several files.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in by]
    spread = F.xxhash64(*df.columns)
    target = [partitions] if partitions else []
    return df.repartitionByRange(*target, *columns, spread).sortWithinPartitions(*columns)
