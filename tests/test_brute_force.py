"""Operators against plain Python on small random inputs."""

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from helpers import SPEC, rows
from tideline import GoldSpec, Measure, QualityRules, Range, aggregate, dedupe_latest, flatten
from tideline import quality_report

CENT = Decimal("0.01")


def half_up(value: Decimal) -> float:
    return float(value.quantize(CENT, ROUND_HALF_UP))


def test_rounded_measures(spark):
    rng = random.Random(1)
    groups = {
        g: [round(rng.uniform(-50, 50), rng.choice((0, 1, 2, 3, 4))) for _ in range(rng.randint(1, 9))]
        for g in range(400)
    }
    data = [(g, v) for g, values in groups.items() for v in values]
    rng.shuffle(data)
    spec = GoldSpec({a: Measure("v", a) for a in ("avg", "sum", "max")}, keys=["g"])
    found = aggregate(spark.createDataFrame(data, "g int, v double"), spec)
    expected = []
    for g, values in sorted(groups.items()):
        exact = [Decimal(repr(v)) for v in values]
        total = sum(exact)
        expected.append((g, half_up(total / len(exact)), half_up(total), half_up(max(exact))))
    assert rows(found, "g") == expected


@pytest.mark.parametrize("parts", [1, 5])
def test_newest_rows(spark, parts):
    rng = random.Random(2)
    names = ["a", "b", None]
    data = [
        (rng.choice(names), rng.randint(0, 9), rng.choice([None, 1, 2, 3]), rng.randint(0, 5))
        for _ in range(600)
    ]
    df = spark.createDataFrame(data, "k string, h int, v int, x int").repartition(parts)
    groups = defaultdict(list)
    for k, h, v, x in data:
        groups[k, h].append((v, x))

    def newest(versions):
        return max(versions, key=lambda p: (p[0] is not None, p[0] or 0, p[1]))

    expected = {(k, h, *newest(g), len(g)) for (k, h), g in groups.items()}
    found = rows(dedupe_latest(df, ["k", "h"], ["v"], copies="n"))
    assert len(found) == len(expected) and set(found) == expected


def test_flattened_rows(spark):
    rng = random.Random(3)

    def array(make):
        return rng.choice([None, [], [make(i) for i in range(rng.randint(1, 6))]])

    data = [
        (str(r), "s", ((array(lambda i: f"h{i}"), array(float), array(lambda i: -1.0 * i)),))
        for r in range(300)
    ]
    kind = """ingestion_timestamp_utc string, source string, payload struct<hourly: struct<
      time: array<string>, temperature_2m: array<double>, wind_speed_10m: array<double>>>"""
    expected = []
    for at, source, ((time, temperature, wind),) in data:
        for i, hour in enumerate(time or []):
            cells = [a[i] if a is not None and i < len(a) else None for a in (temperature, wind)]
            expected.append((at, source, i, hour, *cells))
    found = rows(flatten(spark.createDataFrame(data, kind), SPEC, position="i"))
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_violations(spark):
    rng = random.Random(4)
    data = [
        (rng.choice([None, "a", "b", "c"]), rng.randint(0, 90), rng.choice([None, -1.0, 0.0, 5.0, 9.0]))
        for _ in range(300)
    ]
    rules = QualityRules(required=("k", "x"), key=("k", "h"), ranges={"x": Range(0, 5)})
    found = {
        (r["gate"], r["column"]): r["violations"]
        for r in quality_report(spark.createDataFrame(data, "k string, h int, x double"), rules).collect()
    }
    keys = [(k, h) for k, h, _ in data]
    assert found == {
        ("row_count", ""): 0,
        ("not_null", "k"): sum(k is None for k, _, _ in data),
        ("not_null", "x"): sum(x is None for _, _, x in data),
        ("value_range", "x"): sum(x in (-1.0, 9.0) for _, _, x in data),
        ("no_duplicates", "k, h"): sum(keys.count(k) > 1 for k in set(keys)),
    }
