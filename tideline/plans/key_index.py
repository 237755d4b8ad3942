"""Where the keys of a partitioned table are, for keys that move between partitions.

Beside the table lies one 64-bit fingerprint per key and partition, sorted, of which Parquet
keeps the differences: 5.5 bytes a key at eight million in a partition. A merge joins the fingerprints of its slice with all of them and
so finds the partitions outside the slice that hold an older row of its keys. A Bloom filter
that sends as few merges to wrong partitions needs as many bits (43 a key at one in 10^9), and
one of fewer bits would open every partition as soon as a slice has some hundred keys.
Two keys with the same fingerprint cost an opened partition, not a wrong result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.sources.sinks import gather, partition_folder, remove, subfolders

FINGERPRINT = "_key"
#: Sorted numbers are written as differences (by this version of Parquet's pages, without a dictionary).
AS_DIFFERENCES = {"parquet.writer.version": "v2", "parquet.enable.dictionary": "false"}


@dataclass(frozen=True)
class KeyIndex:
    """Fingerprints of ``key`` by the partition columns ``by``, in a folder of their own."""

    path: str
    key: Sequence[str]
    by: Sequence[str]

    def of(self, rows: DataFrame) -> DataFrame:
        return rows.select(F.xxhash64(*self.key).alias(FINGERPRINT), *self.by)

    def exists(self, spark: SparkSession) -> bool:
        return bool(subfolders(spark, self.path))

    def read(self, like: DataFrame) -> DataFrame:
        """The index; the partition columns have their types from a table's rows."""
        spark = like.sparkSession
        return spark.read.schema(self.of(like).schema).parquet(self.path)

    def elsewhere(self, slice_: DataFrame, own: DataFrame) -> DataFrame:
        """Partitions besides those in ``own`` that hold keys of the slice."""
        mine = self.of(slice_).select(FINGERPRINT).distinct()
        there = self.read(slice_).join(mine, FINGERPRINT, "left_semi").select(*self.by).distinct()
        same = [F.col(f"i.{c}").eqNullSafe(F.col(f"o.{c}")) for c in self.by]
        return there.alias("i").join(own.alias("o"), same, "left_anti")

    def add(self, slice_: DataFrame) -> None:
        """List the slice's keys as well, before its rows are published.

        A run that stops half-way then leaves too many keys in the index, never too few.
        """
        self.of(slice_).distinct().write.mode("append").partitionBy(*self.by).parquet(self.path)

    def replace(self, rows: DataFrame) -> None:
        """The keys of whole partitions, instead of what the index had for them."""
        (
            gather(self.of(rows).distinct(), self.by)
            .sortWithinPartitions(*self.by, FINGERPRINT)
            .write.mode("overwrite")
            .options(partitionOverwriteMode="dynamic", **AS_DIFFERENCES)
            .partitionBy(*self.by)
            .parquet(self.path)
        )

    def drop(self, spark: SparkSession, partitions: Sequence[dict]) -> None:
        for values in partitions:
            remove(spark, partition_folder(spark, self.path, values))
