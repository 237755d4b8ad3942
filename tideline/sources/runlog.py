"""A run log of many runs: a small file a run, compacted by month without disturbing readers."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.audit import AUDIT_SCHEMA
from tideline.sources.sinks import (
    create_file,
    exists,
    files_in,
    gather,
    modified,
    read_file,
    remove,
    subfolders,
)

NOTHING = {"months": {}, "included": [], "retired": []}


@dataclass(frozen=True)
class RunLog:
    """A folder of runs and months, and manifests that say which of them count.

    A run is appended as a folder of its own. ``compact`` writes the months that have new
    runs anew and then a manifest, in one rename: it names the folder of every month
    and the runs that are in them. A reader takes the newest manifest and the runs that it
    doesn't include, so it sees every run once, before and after the rename. Nothing is
    removed but by ``vacuum``, so that a reader with an older manifest finds its files.
    """

    path: str
    schema: T.StructType = AUDIT_SCHEMA
    month_of: str = "start_time"

    def _manifests(self, spark: SparkSession) -> list[str]:
        return files_in(spark, f"{self.path}/manifests", ".json")

    def _manifest(self, spark: SparkSession) -> tuple[int, dict]:
        names = self._manifests(spark)
        if not names:
            return 0, NOTHING
        text = read_file(spark, f"{self.path}/manifests/{names[-1]}")
        return int(names[-1].removesuffix(".json")), json.loads(text)

    def _publish(self, spark: SparkSession, number: int, manifest: Mapping) -> None:
        path = f"{self.path}/manifests/{number:08d}.json"
        if not create_file(spark, path, json.dumps(manifest)):
            raise RuntimeError(f"Another compaction of {self.path} came first")

    def _finished(self, spark: SparkSession) -> list[str]:
        """Runs whose folders are complete."""
        return [
            name
            for name in subfolders(spark, f"{self.path}/runs")
            if exists(spark, f"{self.path}/runs/{name}/_SUCCESS")
        ]

    def _rows(self, spark: SparkSession, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def append(self, df: DataFrame) -> None:
        df.write.parquet(f"{self.path}/runs/{uuid.uuid4().hex}")

    def read(self, spark: SparkSession) -> DataFrame:
        _, manifest = self._manifest(spark)
        included = set(manifest["included"])
        fresh = [f"runs/{name}" for name in self._finished(spark) if name not in included]
        return self._rows(spark, [*manifest["months"].values(), *fresh])

    def compact(self, spark: SparkSession) -> int:
        """Move runs into their months; returns how many folders of runs were moved."""
        number, manifest = self._manifest(spark)
        included = set(manifest["included"])
        fresh = [name for name in self._finished(spark) if name not in included]
        if not fresh:
            return 0
        label = F.date_format(F.col(self.month_of), "yyyy_MM")
        rows = self._rows(spark, [f"runs/{name}" for name in fresh])
        rows = rows.withColumn("month", F.coalesce(label, F.lit("none")))
        # One row a month.
        months = {r[0] for r in rows.select("month").distinct().collect()}
        before = {m: folder for m, folder in manifest["months"].items() if m in months}
        for month, folder in before.items():
            rows = rows.unionByName(self._rows(spark, [folder]).withColumn("month", F.lit(month)))
        root = f"months/{uuid.uuid4().hex}"
        gather(rows, ["month"]).write.partitionBy("month").parquet(f"{self.path}/{root}")
        self._publish(
            spark,
            number + 1,
            {
                "months": {**manifest["months"], **{m: f"{root}/month={m}" for m in months}},
                "included": sorted({*included, *fresh}),
                "retired": sorted({*manifest["retired"], *before.values()}),
            },
        )
        return len(fresh)

    def overwrite(self, df: DataFrame) -> None:
        """These rows instead of all runs so far."""
        spark = df.sparkSession
        number, manifest = self._manifest(spark)
        known = self._finished(spark)
        root = f"months/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{root}")
        retired = {*manifest["retired"], *manifest["months"].values()}
        self._publish(
            spark,
            number + 1,
            {"months": {"all": root}, "included": known, "retired": sorted(retired)},
        )

    def refresh(
        self, touched: DataFrame, whole: DataFrame, gone: Sequence[Mapping[str, object]] = ()
    ) -> None:
        self.overwrite(whole)

    def vacuum(self, spark: SparkSession, older_than_seconds: float) -> int:
        """Remove what no manifest newer than that needs; returns the folders removed.

        A reader must not take longer than ``older_than_seconds`` from listing to reading.
        """
        number, manifest = self._manifest(spark)
        if not number:
            return 0
        newest = f"{self.path}/manifests/{number:08d}.json"
        if modified(spark, newest) > time.time() - older_than_seconds:
            return 0
        there = set(subfolders(spark, f"{self.path}/runs"))
        gone = [f"runs/{name}" for name in manifest["included"] if name in there]
        gone += manifest["retired"]
        if not gone:
            return 0
        for folder in gone:
            remove(spark, f"{self.path}/{folder}")
        # Names of removed runs are not needed any more.
        self._publish(spark, number + 1, {"months": manifest["months"], "included": [], "retired": []})
        return len(gone)
