"""The events table seen as a feed of nested hourly responses.

A response holds the events of one type among ``SPAN`` consecutive ids: its arrays
stay short however large the table is. Several events fall into the same hour,
within a response and across responses, which gives the duplicates that
de-duplication is for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.flatten import conform, flatten
from tideline.plans.weather import VARIABLES
from tideline.sources.bronze import bronze_schema, envelope, land, read_bronze
from tideline.sources.sinks import scratch_path
from tideline.specs import FlattenSpec, GoldSpec, Measure, QualityRules, Range

SPAN = 96
ENVIRONMENT = "dev"

FLATTEN = FlattenSpec(
    root="payload.hourly",
    measures={"event_id": "event_id", "value": "value"},
    types={"event_id": T.LongType()},
)
KEY = ("source", "weather_timestamp", "environment")
RULES = QualityRules(
    required=("weather_timestamp", "value"),
    key=KEY,
    ranges={"value": Range(0, 1000)},
    partition_column="weather_date",
)
STRICT_RULES = QualityRules(
    required=RULES.required, key=KEY, ranges={"value": Range(0, 300)}
)
GOLD = GoldSpec(
    {
        "avg_value": Measure("value", "avg"),
        "total_value": Measure("value", "sum"),
        "max_value": Measure("value", "max"),
        "last_event": Measure("event_id", "max"),
    }
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hour_text(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:00`` of a zone-less timestamp."""
    text = ts.cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 2), F.lit(":00"))


def instant(ts: Column) -> Column:
    """The instant of a zone-less timestamp read as UTC."""
    return F.concat(ts.cast("string"), F.lit("Z")).cast("timestamp")


def _batched(events: DataFrame, arrays: list[str]) -> DataFrame:
    """Columns source, received, payload; ``events`` has the named array elements."""
    entry = F.struct(*dict.fromkeys(["event_id", *arrays]))
    return (
        events.groupBy(F.col("event_type").alias("source"), F.expr(f"event_id div {SPAN}"))
        .agg(
            F.max("ts").alias("received"),
            F.array_sort(F.collect_list(entry)).alias("e"),
        )
        .select(
            "source",
            "received",
            F.struct(
                F.struct(*(F.col(f"e.{name}").alias(name) for name in arrays)).alias("hourly")
            ).alias("payload"),
        )
    )


def _timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("time", hour_text(F.col("ts")))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batched(_timed_events(spark, sf_dir), ["time", "value", "event_id"])


def weather_records(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    """Enveloped responses of the weather feed.

    Temperature is a tenth of the value and humidity the user's number modulo 101, so that
    readings lie within the bounds unless ``hot``: then the value itself is the temperature.
    """
    value = F.col("value")
    readings = _timed_events(spark, sf_dir).withColumns(
        {
            "temperature_2m": value if hot else F.round(value / 10, 3),
            "relative_humidity_2m": (F.col("user_id") % 101).cast("double"),
            "precipitation": value,
            "wind_speed_10m": value,
        }
    )
    batches = _batched(readings, ["time", *VARIABLES])
    return envelope(batches, F.col("source"), ingested_at=F.col("received"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses in their envelopes."""
    return envelope(
        responses(spark, sf_dir),
        F.col("source"),
        {"forecast_days": 1, "hourly": "event_id,value"},
        F.col("received"),
    )


def landed(spark: SparkSession, sf_dir: str) -> str:
    """A bronze folder with all responses."""
    path = scratch_path(spark, "bronze")
    land(records(spark, sf_dir), path, compact=True)
    return path


def bronze(spark: SparkSession, sf_dir: str, ingestion_date: str | None = None) -> DataFrame:
    return read_bronze(spark, landed(spark, sf_dir), bronze_schema(FLATTEN), ingestion_date)


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed hourly rows, straight from the nested records."""
    return conform(flatten(records(spark, sf_dir), FLATTEN), ENVIRONMENT)


def dated(df: DataFrame, column: str = "weather_date") -> DataFrame:
    """Dates as text, which compares the same everywhere."""
    return df.withColumn(column, F.col(column).cast("string"))
