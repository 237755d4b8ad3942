"""Serving and audit tables behind one small interface."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from tideline.sources.sinks import partition_folder, remove, write_partitioned


class Table(Protocol):
    def read(self, spark: SparkSession) -> DataFrame: ...

    def overwrite(self, df: DataFrame) -> None: ...

    def append(self, df: DataFrame) -> None: ...

    def refresh(
        self, touched: DataFrame, whole: DataFrame, gone: Sequence[Mapping[str, object]] = ()
    ) -> None: ...


@dataclass(frozen=True)
class ParquetTable:
    """A parquet folder, flat or partitioned.

    A table must not be overwritten from its own files: store the rows first.
    """

    path: str
    partition_by: Sequence[str] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def overwrite(self, df: DataFrame) -> None:
        if self.partition_by:
            write_partitioned(df, self.path, self.partition_by, mode="static")
        else:
            df.write.mode("overwrite").parquet(self.path)

    def refresh(
        self, touched: DataFrame, whole: DataFrame, gone: Sequence[Mapping[str, object]] = ()
    ) -> None:
        """Publish new content of some partitions; the others' files stay as they are.

        A table without partitions takes the whole content. The partitions ``gone`` have no
        rows any more; a table with other partition columns is written whole for them.
        """
        if self.partition_by and not any(set(g) != set(self.partition_by) for g in gone):
            write_partitioned(touched, self.path, self.partition_by)
            for values in gone:
                remove(touched.sparkSession, partition_folder(touched.sparkSession, self.path, values))
        else:
            self.overwrite(whole)

    def append(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path)


@dataclass(frozen=True)
class JdbcTable:
    """A relational table.

    Overwriting truncates, which keeps the table's grants and indexes.
    ``connections`` bounds the number of parallel writers. Each task commits on
    its own, so a task repeated after its commit, say because its executor was
    lost, leaves rows twice: ``overwrite`` reads the row count back and starts
    over if it is wrong. It evaluates the rows twice, to count and to write, so they
    should be a stored table. An appended row may be there twice after such a loss.
    """

    url: str
    table: str
    user: str | None = None
    password_env: str | None = None
    driver: str | None = None
    connections: int = 8
    batch_size: int = 10_000
    attempts: int = 3
    read_options: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def postgres(
        cls,
        host: str,
        port: int,
        database: str,
        table: str,
        user: str,
        password_env: str,
        **options,
    ) -> "JdbcTable":
        # Form of the URL and class of the driver.
        return cls(
            f"jdbc:postgresql://{host}:{port}/{database}",
            table,
            user=user,
            password_env=password_env,
            driver="org.postgresql.Driver",
            **options,
        )

    def options(self) -> dict[str, str]:
        options = {"url": self.url, "dbtable": self.table}
        if self.user:
            options["user"] = self.user
        if self.password_env:
            options["password"] = os.environ[self.password_env]
        if self.driver:
            options["driver"] = self.driver
        return options

    def _write_options(self) -> dict[str, str]:
        return {
            **self.options(),
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.connections),
        }

    def read(self, spark: SparkSession) -> DataFrame:
        """The table; ``read_options`` may hold Spark's bounds for a parallel read."""
        return spark.read.format("jdbc").options(**self.options(), **self.read_options).load()

    def overwrite(self, df: DataFrame) -> None:
        expected = df.count()
        options = {**self._write_options(), "truncate": "true"}
        for _ in range(self.attempts):
            df.write.format("jdbc").mode("overwrite").options(**options).save()
            found = self.read(df.sparkSession).count()
            if found == expected:
                return
        raise RuntimeError(f"{self.table} holds {found} rows after writing {expected}")

    def refresh(
        self, touched: DataFrame, whole: DataFrame, gone: Sequence[Mapping[str, object]] = ()
    ) -> None:
        self.overwrite(whole)

    def append(self, df: DataFrame) -> None:
        df.write.format("jdbc").mode("append").options(**self._write_options()).save()
