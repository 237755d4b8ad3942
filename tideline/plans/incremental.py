"""Merging a new slice into a partitioned table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tideline.operators.dedupe import dedupe_latest
from tideline.plans.key_index import KeyIndex
from tideline.sources.sinks import (
    fingerprint,
    gather,
    observed,
    partition_folder,
    read_stored,
    read_table,
    remove,
    scratch_path,
    verify,
    write_partitioned,
)


#: Partition column below the declared one, if a table is cut into buckets of its key.
BUCKET = "key_bucket"


def bucketed(rows: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Rows with the bucket of their key, which lies below their partition; 0 for none."""
    if not buckets:
        return rows
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def units(partition_column: str, buckets: int) -> list[str]:
    """The columns whose values name what a merge reads and replaces as a whole."""
    return [partition_column, *([BUCKET] if buckets else [])]


@dataclass(frozen=True)
class Span:
    """What a slice touches: least and greatest partition value, rows without one, buckets.

    ``elsewhere`` lists further partition values (see ``KeyIndex``).
    """

    low: object
    high: object
    nulls: int
    buckets: Sequence[int] = ()
    elsewhere: Sequence = ()

    @classmethod
    def metrics(cls, column: str, buckets: int = 0, where: Column | None = None) -> dict[str, Column]:
        """What to observe while the slice is stored, of the rows that ``where`` holds for."""
        kept = F.lit(True) if where is None else where
        found = {
            "_low": F.min(F.when(kept, F.col(column))),
            "_high": F.max(F.when(kept, F.col(column))),
            "_nulls": F.count_if(kept & F.col(column).isNull()),
        }
        if buckets:
            found["_buckets"] = F.collect_set(F.when(kept, F.col(BUCKET)))
        return found

    @classmethod
    def of(cls, seen: Mapping[str, object]) -> Span:
        return cls(
            seen["_low"], seen["_high"], seen["_nulls"], sorted(seen.get("_buckets", ()))
        )


def touched_rows(existing: DataFrame, slice_: DataFrame, column: str, span: Span) -> DataFrame:
    """Stored rows in the partitions that the slice has rows for.

    The span is a literal, so the scan opens no partition outside it; a semi join with
    the slice's own values leaves out those in between. Rows without a value lie in one
    partition, which is opened only if the slice has such rows. ``slice_`` may also be
    the table of the touched partitions alone.
    """
    rows, by = existing.limit(0), [column]
    if span.buckets:
        existing = existing.filter(F.col(BUCKET).isin(list(span.buckets)))
        by.append(BUCKET)
    value = F.col(column)
    inside = value.between(F.lit(span.low), F.lit(span.high)) if span.low is not None else None
    if others := [v for v in span.elsewhere if v is not None]:
        inside = value.isin(others) if inside is None else inside | value.isin(others)
    if inside is not None:
        own = slice_.select(*(F.col(c).alias(f"_touched_{c}") for c in by)).distinct()
        same = [F.col(c) == F.col(f"_touched_{c}") for c in by]
        rows = existing.filter(inside).join(own, same, "left_semi")
    if span.nulls:
        without = existing.filter(value.isNull())
        rows = without if inside is None else rows.unionByName(without)
    return rows


def merge_slice(
    slice_: DataFrame,
    existing: DataFrame | None,
    key: Sequence[str],
    version: Sequence[Column | str],
    partition_column: str,
    span: Span,
    copies: str | None = None,
    touched: DataFrame | None = None,
) -> DataFrame:
    """New content of all partitions the slice touches, newest row per key.

    Rows already there are kept unless the slice has a newer version, so a date
    that is only partly covered loses nothing and a repeated slice changes nothing.
    Columns that only the table has stay, also in rows that the slice renews; columns
    that only the slice has are NULL in older rows. A key is looked for in the partitions
    of the slice, or in those of ``touched``, the table that ``touched_units`` gives for keys
    that move. ``slice_`` is read twice and should be a stored table.
    """
    if existing is None:
        return dedupe_latest(slice_, key, version, copies)
    only_stored = [name for name in existing.columns if name not in slice_.columns]
    there = touched_rows(existing, slice_ if touched is None else touched, partition_column, span)
    rows = slice_.unionByName(there, allowMissingColumns=True)
    return dedupe_latest(rows, key, version, copies, carried=only_stored)


def keys_in_several(table: DataFrame, key: Sequence[str], partition_column: str) -> DataFrame:
    """Keys that have rows in more than one partition, with the number of partitions.

    A merge without a ``KeyIndex`` can't see them; a source whose keys move should have one.
    """
    apart = table.groupBy(*key, partition_column).agg(F.count(F.lit(1)).alias("rows"))
    return (
        apart.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("partitions"))
        .filter(F.col("partitions") > 1)
    )


def touched_units(
    slice_: DataFrame, index: KeyIndex, span: Span, partition_column: str
) -> tuple[DataFrame, Span]:
    """The partitions a slice touches if its keys may lie elsewhere, and the span with them.

    The partition values outside the slice come to the driver, at most as many as the table
    has partitions.
    """
    spark, path = slice_.sparkSession, scratch_path(slice_.sparkSession, "touched")
    own = slice_.select(*index.by).distinct()
    elsewhere = index.elsewhere(slice_, own).withColumn("_elsewhere", F.lit(True))
    own.withColumn("_elsewhere", F.lit(False)).unionByName(elsewhere).write.parquet(path)
    touched = spark.read.parquet(path)
    found = [r[0] for r in touched.filter("_elsewhere").select(partition_column).distinct().collect()]
    span = replace(span, nulls=span.nulls + (None in found), elsewhere=[v for v in found if v is not None])
    return touched.drop("_elsewhere"), span


def emptied(touched: DataFrame, merged: DataFrame, by: Sequence[str]) -> list[dict]:
    """Partitions of ``touched`` that have no row any more, because all their keys moved."""
    left = merged.select(*by).distinct().alias("m")
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"m.{c}")) for c in by]
    return [r.asDict() for r in touched.alias("t").join(left, same, "left_anti").collect()]


def store_merged(
    merged: DataFrame,
    partition_column: str,
    metrics: dict[str, Column],
    only_counted: Sequence[str] = (),
    path: str | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Store merged rows aside, gathered by partition, with the metrics counted on the way.

    Aside, because they are computed from the very files they will replace. The
    copy has no partition directories, which would only double the small files.
    Columns ``only_counted`` serve the metrics and are not stored. The fingerprint of the
    stored rows is among the counts.
    """
    spark, seen = merged.sparkSession, Observation()
    path = path or scratch_path(spark, "merged")
    kept = [c for c in merged.columns if c not in only_counted]
    by = [partition_column, *([BUCKET] if BUCKET in kept else [])]
    metrics = {**metrics, **fingerprint(kept, merged.schema)}
    rows = observed(gather(merged, by), seen, metrics).select(*kept)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path), seen.get


def publish(
    stored: DataFrame,
    path: str,
    partition_column: str,
    mode: str = "dynamic",
    gone: Sequence[dict] = (),
) -> None:
    """Copy a stored, already gathered table into place without a shuffle.

    The partitions ``gone`` have no rows any more and are removed.
    """
    by = [partition_column, *([BUCKET] if BUCKET in stored.columns else [])]
    write_partitioned(stored, path, by, mode=mode, gathered=True)
    for values in gone:
        remove(stored.sparkSession, partition_folder(stored.sparkSession, path, values))


def verify_published(
    stored: DataFrame,
    path: str,
    partition_column: str,
    expected: Mapping[str, int],
    span: Span | None,
) -> None:
    """Compare the published partitions with the rows that were stored for them.

    ``span`` bounds the partitions to open; None stands for the whole table.
    """
    published = read_table(stored.sparkSession, path, stored.schema)
    if span is not None:
        published = touched_rows(published, stored, partition_column, span)
    verify(published, expected, path)


def upsert(
    spark: SparkSession,
    slice_: DataFrame,
    path: str,
    key: Sequence[str],
    version: Sequence[Column | str],
    partition_column: str,
    buckets: int = 0,
    moving_keys: bool = False,
    check: bool = False,
) -> int:
    """Merge a slice into the parquet table at ``path``; returns the rows written.

    ``buckets`` cuts every partition into as many buckets of the key, of which a merge
    replaces only those it has rows for. ``moving_keys`` keeps a ``KeyIndex`` beside the
    table, so that a key that comes in another partition leaves the old one. ``check``
    reads the published rows back. A table keeps the settings it was made with.
    """
    stored, seen = scratch_path(spark, "slice"), Observation()
    slice_ = bucketed(slice_, key, buckets)
    observed(slice_, seen, Span.metrics(partition_column, buckets)).write.parquet(stored)
    slice_, span = spark.read.schema(slice_.schema).parquet(stored), Span.of(seen.get)
    existing = read_stored(spark, path, slice_.schema, units(partition_column, buckets))
    merge = Merge(slice_, existing, path, key, partition_column, buckets, moving_keys, span)
    merged, counts = store_merged(merge.rows(version), partition_column, {})
    merge.publish(merged)
    if check:
        verify_published(merged, path, partition_column, counts, merge.span)
    return counts["_rows"]


class Merge:
    """One slice on its way into a table: what it touches, and what becomes of the index."""

    def __init__(
        self,
        slice_: DataFrame,
        existing: DataFrame | None,
        path: str,
        key: Sequence[str],
        partition_column: str,
        buckets: int,
        moving_keys: bool,
        span: Span,
    ) -> None:
        self.slice, self.existing, self.path, self.key = slice_, existing, path, key
        self.partition_column, self.span = partition_column, span
        self.by = units(partition_column, buckets)
        self.index = KeyIndex(f"{path.rstrip('/')}_keys", key, self.by) if moving_keys else None
        self.touched: DataFrame | None = None
        if self.index is not None and existing is not None:
            if not self.index.exists(slice_.sparkSession):
                self.index.replace(existing)
            self.touched, self.span = touched_units(slice_, self.index, span, partition_column)

    def rows(self, version: Sequence[Column | str], copies: str | None = None) -> DataFrame:
        return merge_slice(
            self.slice,
            self.existing,
            self.key,
            version,
            self.partition_column,
            self.span,
            copies,
            self.touched,
        )

    def gone(self, merged: DataFrame) -> list[dict]:
        """Partitions that the merge leaves without a row."""
        return [] if self.touched is None else emptied(self.touched, merged, self.by)

    def publish(
        self, merged: DataFrame, mode: str = "dynamic", gone: Sequence[dict] | None = None
    ) -> None:
        """Rows into place, emptied partitions out of it, and the index after them."""
        spark = merged.sparkSession
        gone = self.gone(merged) if gone is None else gone
        if self.index is not None:
            self.index.add(self.slice)
        publish(merged, self.path, self.partition_column, mode, gone)
        if self.index is not None:
            if mode == "static":
                remove(spark, self.index.path)
            self.index.replace(merged)
            self.index.drop(spark, gone)
