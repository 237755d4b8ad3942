"""The run log: one row per run, and the questions operators ask of it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and states of the run log.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("environment", T.StringType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("bronze_row_count", T.LongType()),
        T.StructField("silver_row_count", T.LongType()),
        T.StructField("gold_row_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)
SUCCESS = "SUCCESS"
FAILED = "FAILED"


@dataclass(frozen=True)
class AuditEntry:
    """Times carry a zone; no error is an empty text."""

    environment: str
    pipeline_name: str
    start_time: datetime
    end_time: datetime
    bronze_row_count: int
    silver_row_count: int
    gold_row_count: int
    status: str
    error_message: str = ""


def audit_frame(spark: SparkSession, entries: Sequence[AuditEntry]) -> DataFrame:
    """The given runs as rows; a run writes one, so one task is enough."""
    rows = [tuple(asdict(entry).values()) for entry in entries]
    return spark.createDataFrame(rows, AUDIT_SCHEMA).coalesce(1)


def _newest_first() -> list[Column]:
    """Runs that start together are ordered by the rest of their rows."""
    rest = ["end_time", "environment", "pipeline_name", "status", "error_message"]
    return [F.desc("start_time"), *(F.desc(name) for name in rest)]


def history(log: DataFrame, errors: bool = False) -> DataFrame:
    """All runs, newest first; with ``errors`` also their error texts."""
    ordered = log.orderBy(*_newest_first())
    return ordered if errors else ordered.drop("error_message")


def failures(log: DataFrame, everything: bool = False) -> DataFrame:
    """Failed runs, newest first: their start and error, or ``everything`` of them."""
    failed = log.filter(F.col("status") == FAILED).orderBy(*_newest_first())
    return failed if everything else failed.select("start_time", "status", "error_message")


def latest_status(log: DataFrame) -> DataFrame:
    """State of the newest run of every pipeline and environment."""
    newest = F.max(F.struct("start_time", "end_time", "status"))
    return (
        log.groupBy("environment", "pipeline_name")
        .agg(newest.alias("newest"))
        .select("environment", "pipeline_name", "newest.start_time", "newest.status")
    )
