"""Declarations that drive the operators: what to flatten, check and aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

from tideline.functions.measures import AGGREGATIONS


@dataclass(frozen=True)
class FlattenSpec:
    """Parallel arrays under one struct, aligned by position.

    ``measures`` maps an output column to the array field that feeds it. The
    ``axis`` array alone decides how many rows a record gives.
    """

    root: str
    measures: Mapping[str, str]
    axis: str = "time"
    timestamp: str = "weather_timestamp"
    carry: Sequence[str] = ("ingestion_timestamp_utc", "source")
    types: Mapping[str, T.DataType] = field(default_factory=dict)

    def type_of(self, measure: str) -> T.DataType:
        return self.types.get(measure, T.DoubleType())


@dataclass(frozen=True)
class Range:
    """Inclusive bounds; a bound left out is not checked."""

    min: float | None = None
    max: float | None = None


@dataclass(frozen=True)
class QualityRules:
    required: Sequence[str] = ()
    key: Sequence[str] = ()
    ranges: Mapping[str, Range] = field(default_factory=dict)
    partition_column: str | None = None

    @classmethod
    def from_metadata(cls, metadata: Mapping) -> "QualityRules":
        """Rules from a source's metadata entry (primary key, required columns, bounds)."""
        return cls(
            required=tuple(metadata.get("required_columns", ())),
            key=tuple(metadata.get("primary_key", ())),
            ranges={
                column: Range(bounds.get("min"), bounds.get("max"))
                for column, bounds in metadata.get("validation_rules", {}).items()
            },
            partition_column=metadata.get("partition_column"),
        )


@dataclass(frozen=True)
class Measure:
    source_column: str
    aggregation: str

    def __post_init__(self) -> None:
        if self.aggregation not in AGGREGATIONS:
            raise ValueError(f"Unsupported aggregation type: {self.aggregation}")


@dataclass(frozen=True)
class GoldSpec:
    """Grouped summary: one output column per entry of ``measures``.

    Values enter averages and sums with ``scale`` decimals; the published value is rounded
    to ``digits``.
    """

    measures: Mapping[str, Measure]
    # Fixed value: the default grouping key.
    keys: Sequence[str] = ("environment", "source", "weather_date")
    digits: int = 2
    scale: int = 9

    def __post_init__(self) -> None:
        if not self.measures:
            raise ValueError("A gold summary needs at least one measure")
        if not 0 <= self.digits <= self.scale <= 9:
            raise ValueError("Decimals must satisfy 0 <= digits <= scale <= 9")

    @classmethod
    def from_mapping(cls, aggregations: Mapping[str, Mapping[str, str]], **options) -> "GoldSpec":
        """Measures from ``{output: {"source_column": ..., "aggregation": ...}}``."""
        return cls(
            {
                output: Measure(entry["source_column"], entry["aggregation"])
                for output, entry in aggregations.items()
            },
            **options,
        )
