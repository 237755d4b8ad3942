import pytest

from helpers import put
from tideline import ParquetTable, run
from tideline.operators.inspect import describe_schema
from tideline.plans.weather import weather_run
from tideline.sources.sinks import read_table

GOLD = {
    "avg_temperature": {"source_column": "temperature_2m", "aggregation": "avg"},
    "total_precipitation": {"source_column": "precipitation", "aggregation": "sum"},
}


def response(at: str) -> dict:
    return {
        "ingestion_timestamp_utc": at,
        "source": "open_meteo",
        "request_params": {"latitude": 51.5072, "hourly": "temperature_2m", "forecast_days": 1},
        "payload": {
            "elevation": 16.0,
            "hourly_units": {"time": "iso8601"},
            "hourly": {
                "time": [f"2026-06-18T{h:02d}:00" for h in range(24)],
                "temperature_2m": [15 + h / 10 for h in range(24)],
                "relative_humidity_2m": [60 + h for h in range(24)],
                "precipitation": [0.1] * 24,
                "wind_speed_10m": [h / 2 for h in range(24)],
            },
        },
    }


def test_pretty_printed_responses_to_daily_summary(spark, tmp_path):
    spec = weather_run(
        "test", str(tmp_path), GOLD, ParquetTable(str(tmp_path / "serving")), documents=True
    )
    for hour in ("05", "06"):
        again = response(f"2026-06-18T{hour}:00:00+00:00")
        put(spec.bronze_path, "2026_06_18", again, name=f"{hour}.json", indent=2)
    result = run(spark, spec, "2026_06_18")
    assert (result.bronze_rows, result.flattened_rows) == (2, 48)
    assert (result.silver_rows, result.gold_rows) == (24, 1)
    silver = read_table(spark, spec.silver_path)
    assert {r[0] for r in silver.select("ingestion_timestamp_utc").collect()} == {
        "2026-06-18T06:00:00+00:00"
    }
    assert describe_schema(silver) == [
        ("ingestion_timestamp_utc", "string"),
        ("source", "string"),
        ("weather_timestamp", "string"),
        ("temperature_2m", "double"),
        ("relative_humidity_2m", "double"),
        ("precipitation", "double"),
        ("wind_speed_10m", "double"),
        ("environment", "string"),
        ("weather_date", "date"),
    ]
    row = spec.serving.read(spark).first()
    assert row["environment"] == "test" and str(row["weather_date"]) == "2026-06-18"
    assert row["avg_temperature"] == 16.15 and row["total_precipitation"] == 2.4


def test_unknown_environment(tmp_path):
    with pytest.raises(ValueError, match="Unknown environment: qa"):
        weather_run("qa", str(tmp_path), GOLD)
