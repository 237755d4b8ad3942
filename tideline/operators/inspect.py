"""Looking at a table without reading all of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def sample(df: DataFrame, rows: int = 10, order_by: Sequence[Column | str] = ()) -> DataFrame:
    """A few rows: any, or the first in the given order (kept as a bounded top-n per task)."""
    return df.orderBy(*order_by).limit(rows) if order_by else df.limit(rows)


def describe_schema(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types, without a job."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
