"""The hourly weather feed, declared."""

from __future__ import annotations

from collections.abc import Mapping

from tideline.plans.run import RunSpec
from tideline.sources.tables import Table
from tideline.specs import FlattenSpec, GoldSpec, QualityRules, Range

# Environments, source label, variables, key, required columns and bounds.
ENVIRONMENTS = ("dev", "test", "prod")
SOURCE = "open_meteo"
VARIABLES = ("temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m")
KEY = ("source", "weather_timestamp", "environment")
REQUIRED = ("weather_timestamp", "temperature_2m", "relative_humidity_2m")
BOUNDS = {"temperature_2m": Range(-50, 60), "relative_humidity_2m": Range(0, 100)}

FLATTEN = FlattenSpec(root="payload.hourly", measures={name: name for name in VARIABLES})
RULES = QualityRules(
    required=REQUIRED, key=KEY, ranges=BOUNDS, partition_column="weather_date"
)


def weather_run(
    environment: str,
    lake: str,
    gold_aggregations: Mapping[str, Mapping[str, str]] | GoldSpec,
    serving: Table | None = None,
    audit: Table | None = None,
    **options,
) -> RunSpec:
    """Run declaration for one environment, with layers below ``lake/<environment>``.

    ``gold_aggregations`` maps every published column to its source column and
    aggregation. Other options are those of ``RunSpec``; ``documents=True`` reads
    pretty-printed response files.
    """
    if environment not in ENVIRONMENTS:
        raise ValueError(f"Unknown environment: {environment}")
    if not isinstance(gold_aggregations, GoldSpec):
        gold_aggregations = GoldSpec.from_mapping(gold_aggregations)
    return RunSpec(
        source=SOURCE,
        environment=environment,
        bronze=f"{lake}/{environment}/bronze",
        silver=f"{lake}/{environment}/silver",
        gold=f"{lake}/{environment}/gold",
        flatten=FLATTEN,
        rules=RULES,
        aggregations=gold_aggregations,
        serving=serving,
        audit=audit,
        **options,
    )
