"""Parallel arrays to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import date_of, element
from tideline.specs import FlattenSpec


def _as_read(bronze: DataFrame, spec: FlattenSpec) -> DataFrame:
    return bronze.select(
        *spec.carry,
        F.col(f"{spec.root}.{spec.axis}").alias(spec.timestamp),
        *(F.col(f"{spec.root}.{array}").alias(name) for name, array in spec.measures.items()),
    )


def project_arrays(bronze: DataFrame, spec: FlattenSpec) -> DataFrame:
    """Lift the nested arrays to top-level columns under their output names and types.

    An element that its type can't read is NULL; ``flatten`` can also tell which.
    """
    rows = _as_read(bronze, spec)
    return rows.withColumns(
        {name: F.col(name).try_cast(T.ArrayType(spec.type_of(name))) for name in spec.measures}
    )


def flatten(
    bronze: DataFrame,
    spec: FlattenSpec,
    position: str | None = None,
    unreadable: str | None = None,
) -> DataFrame:
    """One row per entry of the axis array.

    A measure array that is too short gives NULL, surplus entries are dropped and
    a record with no axis gives no row. Measures that come as text are cast one by one:
    an unreadable one is NULL and leaves its neighbours alone. ``unreadable`` names an
    optional column that lists the row's unreadable values as (column, text). The
    generator and the element lookups share one codegen stage, so the arrays are not
    copied per row.
    """
    index = position or "_position"
    rows = _as_read(bronze, spec).select(
        *spec.carry,
        F.posexplode(spec.timestamp).alias(index, spec.timestamp),
        *spec.measures,
    )
    values, faults = [], []
    for name in spec.measures:
        raw = element(F.col(name), F.col(index))
        value, target = raw, spec.type_of(name)
        if rows.schema[name].dataType.elementType == T.StringType() != target:
            value = raw.try_cast(target)
            fault = F.struct(F.lit(name).alias("column"), raw.alias("text"))
            faults.append(F.when(raw.isNotNull() & value.isNull(), fault))
        values.append(value.alias(name))
    listed = []
    if unreadable:
        none = F.array().cast("array<struct<column:string,text:string>>")
        listed = [(F.array_compact(F.array(*faults)) if faults else none).alias(unreadable)]
    return rows.select(
        *spec.carry, *([position] if position else []), spec.timestamp, *values, *listed
    )


def conform(
    rows: DataFrame,
    environment: str,
    timestamp: str = "weather_timestamp",
    date: str = "weather_date",
) -> DataFrame:
    """Add the environment constant and the calendar date of the row."""
    return rows.withColumns(
        {"environment": F.lit(environment), date: date_of(F.col(timestamp))}
    )
