"""Partitioned parquet tables and the shared scratch folder."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


log = logging.getLogger(__name__)


def _folder(spark: SparkSession, path: str):
    """Spark's own file system for a path, and the path in it."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def exists(spark: SparkSession, path: str) -> bool:
    store, folder = _folder(spark, path)
    return store.exists(folder)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, for code that doesn't know the cluster's default one."""
    store, folder = _folder(spark, path)
    uri = store.makeQualified(folder).toUri()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order; a missing one has none."""
    store, folder = _folder(spark, path)
    if not store.exists(folder):
        return []
    found = store.listStatus(folder)
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; a missing one is no error."""
    store, folder = _folder(spark, path)
    store.delete(folder, True)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place as a whole; False if there is one already.

    It is written aside and renamed, so that a reader sees all of it or none.
    """
    store, target = _folder(spark, path)
    if store.exists(target):
        return False
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = store.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    done = store.rename(aside, target)
    if not done:
        store.delete(aside, False)
    return done


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    store, file = _folder(spark, path)
    size = store.getFileStatus(file).getLen()
    source = store.open(file)
    try:
        return bytes(source.readNBytes(size)).decode()
    finally:
        source.close()


def files_in(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Names of the files in a folder that end so, in order; a missing folder has none."""
    store, folder = _folder(spark, path)
    if not store.exists(folder):
        return []
    names = (f.getPath().getName() for f in store.listStatus(folder))
    return sorted(n for n in names if n.endswith(suffix))


def modified(spark: SparkSession, path: str) -> float:
    """When a file was last written, in seconds since 1970."""
    store, file = _folder(spark, path)
    return store.getFileStatus(file).getModificationTime() / 1000


def partition_folder(spark: SparkSession, path: str, values: Mapping[str, object]) -> str:
    """The directory of a partition, named as Spark names it."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    parts = (
        utils.getPartitionPathString(name, None if value is None else str(value))
        for name, value in values.items()
    )
    return "/".join([path, *parts])


class StoreMismatch(RuntimeError):
    """Published files do not hold the rows that were written."""


def fingerprint(columns: Sequence[str], schema: T.StructType) -> dict[str, Column]:
    """Count, sum and xor of the rows' hashes: equal for equal rows, in any order and file."""

    def hashable(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(hashable(f.dataType) for f in kind)
        if isinstance(kind, T.ArrayType):
            return hashable(kind.elementType)
        return not isinstance(kind, (T.MapType, T.VariantType))

    # Null hashes like nothing, so that a value could change places with its neighbour.
    parts = [
        c
        for name in sorted(columns)
        for c in (
            F.col(name).isNull(),
            F.col(name) if hashable(schema[name].dataType) else F.to_json(name),
        )
    ]
    row = F.xxhash64(*parts)
    return {
        "_rows": F.count(F.lit(1)),
        "_sum": F.coalesce(F.sum(F.pmod(row, F.lit(1 << 20))), F.lit(0)),
        "_xor": F.coalesce(F.bit_xor(row), F.lit(0).cast("long")),
    }


def verify(stored: DataFrame, expected: Mapping[str, int], what: str) -> None:
    """Read rows back and compare them with the fingerprint observed when they were written."""
    metrics = fingerprint(stored.columns, stored.schema)
    found = stored.agg(*(c.alias(name) for name, c in metrics.items())).first().asDict()
    wrong = {name: (expected[name], found[name]) for name in found if found[name] != expected[name]}
    if wrong:
        rows = f"{found['_rows']} rows after writing {expected['_rows']}"
        raise StoreMismatch(f"{what} holds other rows than were written: {rows}, {wrong}")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tideline-")
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder for a table that cuts lineage, under the shared folder."""
    return f"{shared_folder(spark)}/tideline/{label}-{uuid.uuid4().hex}"


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    missing_ok: bool = False,
) -> DataFrame | None:
    """Parquet table; a known schema saves the look into a footer."""
    if missing_ok and not exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_stored(
    spark: SparkSession, path: str, like: T.StructType, by: str | Sequence[str]
) -> DataFrame | None:
    """A partitioned table with all columns it has, or None if there is none yet.

    Only the partition columns take their types from ``like``: directories don't tell them.
    """
    by = [by] if isinstance(by, str) else list(by)
    if not any("=" in name for name in subfolders(spark, path)):
        return None
    found = spark.read.parquet(path).schema
    fields = [f for f in found if f.name not in by] + [like[name] for name in by]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def gather(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together, so it is not a file per task.

    Adaptive execution then cuts large partitions into several tasks and merges
    small ones: one date may hold most of the table. Without adaptive execution
    nothing could cut them: the rows stay where they are, with a warning.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        log.warning("Adaptive execution is off: every task writes a file per partition")
        return df
    return df.hint("rebalance", *(F.col(name) for name in by))


def observed(df: DataFrame, observation: Observation, metrics: dict[str, Column]) -> DataFrame:
    """Count while writing instead of in a job of its own.

    Put it after the last shuffle: tasks of the writing stage count once even if
    executors are lost and earlier stages run again.
    """
    return df.observe(observation, *(c.alias(name) for name, c in metrics.items()))


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    mode: str = "dynamic",
    gathered: bool = False,
    observe: tuple[Observation, dict[str, Column]] | None = None,
) -> None:
    """Write a parquet table partitioned by the given columns.

    ``dynamic`` replaces only the partitions that ``df`` has rows for,
    ``static`` the whole table. Rows are gathered first unless they already are.
    """
    if mode not in ("dynamic", "static"):
        raise ValueError(f"Unknown overwrite mode: {mode}")
    if not gathered:
        df = gather(df, by)
    if observe is not None:
        df = observed(df, *observe)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*by)
        .parquet(path)
    )
