"""Intermediate tables in the shared folder of the cluster.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading it
back: the files are columnar, every executor can reach them, and a lost executor
costs at most the tasks that read them. A folder belongs to one run of an
operator; ``drop`` removes a table once a later one is written, and what is left
goes when the session's JVM ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultspan.session import ensure_checkpoint_dir


def unused(columns: list[str], name: str) -> str:
    """The name, lengthened until no column has it; Spark ignores case in names."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


class Scratch:
    def __init__(self, spark: SparkSession, name: str):
        ensure_checkpoint_dir(spark)
        self._spark = spark
        self.folder = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._count = 0
        path = self._path(self.folder)
        self._file_system(path).deleteOnExit(path)

    def _path(self, name: str):
        return self._spark._jvm.org.apache.hadoop.fs.Path(name)

    def _file_system(self, path):
        return path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())

    def store(self, rows: DataFrame, name: str) -> DataFrame:
        """Write the rows once and read them back."""
        self._count += 1
        place = f"{self.folder}/{name}-{self._count}"
        rows.write.parquet(place)
        stored = self._spark.read.schema(rows.schema).parquet(place)
        stored._scratch_place = place
        return stored

    def drop(self, *stored: DataFrame) -> None:
        """Remove tables that nothing will read again."""
        for rows in stored:
            path = self._path(rows._scratch_place)
            self._file_system(path).delete(path, True)


def numbered(scratch: Scratch, rows: DataFrame, order: list[str], column: str) -> DataFrame:
    """Add the rank of each row, from 0, in the total order of ``order``; native operations only.

    One range shuffle on the whole order, so one hot leading value is still cut.
    The ranges come from a sample, hence they are stored before they are counted
    and numbered. Only one count per range is joined back. Rows that are equal in
    all of ``order`` are interchangeable.
    """
    ranged = scratch.store(
        rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
        .withColumn("_slot", F.monotonically_increasing_id()),
        "ranged",
    )
    part, place = F.shiftright("_slot", 33), F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # a row per range, so one task orders no more than the number of shuffle partitions
        ranged.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # a row per range: bounded by the number of shuffle partitions
        .withColumn(column, place + F.col("_offset"))
        .drop("_part", "_slot", "_offset")
    )
