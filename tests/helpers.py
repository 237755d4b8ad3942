"""Small hand-made inputs."""

from __future__ import annotations

import json
from pathlib import Path

from tideline import FlattenSpec, GoldSpec, Measure, ParquetTable, QualityRules, Range, RunSpec

SPEC = FlattenSpec(
    root="payload.hourly",
    measures={"temperature_2m": "temperature_2m", "wind_speed_10m": "wind_speed_10m"},
)
KEY = ("source", "weather_timestamp", "environment")
RULES = QualityRules(
    required=("weather_timestamp", "temperature_2m"),
    key=KEY,
    ranges={"temperature_2m": Range(-50, 60)},
    partition_column="weather_date",
)
GOLD = GoldSpec(
    {
        "avg_temperature": Measure("temperature_2m", "avg"),
        "max_wind": Measure("wind_speed_10m", "max"),
    }
)


def record(time, temperature, wind=None, at="2024-01-01T00:00:00.000000+00:00", source="s"):
    hourly = {"time": time, "temperature_2m": temperature}
    if wind is not None:
        hourly["wind_speed_10m"] = wind
    return {"ingestion_timestamp_utc": at, "source": source, "payload": {"hourly": hourly}}


def put(root, date: str, *records, name="part-0.json", indent=None) -> None:
    """Write records as JSON lines, or one document if ``indent`` is given."""
    folder = Path(root) / f"ingestion_date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(r if isinstance(r, str) else json.dumps(r, indent=indent) for r in records)
    (folder / name).write_text(text)


def run_spec(root, **options) -> RunSpec:
    settings = dict(
        source="src",
        environment="dev",
        bronze=f"{root}/bronze",
        silver=f"{root}/silver",
        gold=f"{root}/gold",
        flatten=SPEC,
        rules=RULES,
        aggregations=GOLD,
        serving=ParquetTable(f"{root}/serving"),
        audit=ParquetTable(f"{root}/audit"),
    )
    return RunSpec(**{**settings, **options})


def rows(df, *order) -> list[tuple]:
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else [
        tuple(r) for r in df.collect()
    ]
