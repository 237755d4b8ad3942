"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.sources.sinks import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str) -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    This cuts the lineage: a lost executor costs the tasks it ran, not the
    stages before, and a table that is used twice is computed once.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def filesystem(path: str):
    """The file system of a folder and the folder's path there, for Python workers."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


#: Bytes of text a worker takes at a time.
SLICE = 8 << 20


def slices(batches, column: int, size: int = SLICE):
    """Batches of at most ``size`` bytes of text in a column, or of one longer text.

    Bounds what a worker holds as Python objects, whatever the batches Spark sends.
    """
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        part = (np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype="i8") - 1) // size
        cuts = (np.flatnonzero(np.diff(part)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if a < b:
                yield batch.slice(a, b - a)


def map_rows(df: DataFrame, change, added: list[T.StructField] | None = None) -> DataFrame:
    """Arrow batches of all columns through ``change``, under any column names.

    The result has the columns of ``df`` and those of ``added`` after them; ``change``
    goes by position.
    """
    fields = [*df.schema.fields, *(added or [])]
    plain = [T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(fields)]
    columns = [f.name for f in plain[: len(df.columns)]]
    return df.toDF(*columns).mapInArrow(change, T.StructType(plain)).toDF(*(f.name for f in fields))
