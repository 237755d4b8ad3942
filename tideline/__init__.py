"""Layered batch data (bronze, silver, gold) with plain Spark DataFrames."""

from tideline.operators.aggregate import aggregate
from tideline.operators.dedupe import dedupe_latest, distinct_keys
from tideline.operators.flatten import conform, flatten, project_arrays
from tideline.operators.quality import QualityError, duplicate_keys, enforce, quality_report
from tideline.plans.incremental import upsert
from tideline.plans.run import RunResult, RunSpec, run
from tideline.sources.runlog import RunLog
from tideline.sources.tables import JdbcTable, ParquetTable
from tideline.specs import FlattenSpec, GoldSpec, Measure, QualityRules, Range
from tideline.streaming.intake import intake

__all__ = [
    "FlattenSpec",
    "GoldSpec",
    "JdbcTable",
    "Measure",
    "ParquetTable",
    "QualityError",
    "QualityRules",
    "Range",
    "RunLog",
    "RunResult",
    "RunSpec",
    "aggregate",
    "conform",
    "dedupe_latest",
    "distinct_keys",
    "duplicate_keys",
    "enforce",
    "flatten",
    "intake",
    "project_arrays",
    "quality_report",
    "run",
    "upsert",
]
