import json
from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import SPEC, put, record
from tideline import flatten
from tideline.functions.scalars import day_label, iso_utc, utc_wall_clock
from tideline.sources.bronze import (
    bronze_schema,
    envelope,
    ingestion_dates,
    land,
    propose_flatten,
    raw_path,
    read_bronze,
    record_health,
)

SCHEMA = bronze_schema(SPEC)


def health(df):
    return tuple(record_health(df, SPEC).first())


def test_envelope_round_trip(spark, tmp_path):
    responses = spark.createDataFrame(
        [
            (
                '{"hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [1.5]},'
                ' "extra": [1, {}]}',
            )
        ],
        "payload string",
    )
    at = F.lit(datetime(2024, 1, 1, 23, 59, 59, 5, tzinfo=timezone.utc))
    records = envelope(responses, "api", {"latitude": 51.5, "hourly": "a,b"}, at)
    path = raw_path(str(tmp_path), "api")
    land(records, path)
    text = spark.read.text(path).first()
    assert text["ingestion_date"] == "2024_01_01"
    assert '"request_params":{"latitude":51.5,"hourly":"a,b"}' in text["value"]
    assert text["value"].endswith(f'"payload":{responses.first()[0]}}}')
    back = read_bronze(spark, path, SCHEMA).first()
    assert back["ingestion_timestamp_utc"] == "2024-01-01T23:59:59.000005+00:00"
    assert back["source"] == "api"
    assert back["payload"]["hourly"]["time"] == ["2024-01-01T00:00"]
    assert back["payload"]["hourly"]["wind_speed_10m"] is None


def test_landing_twice_appends(spark, tmp_path):
    responses = spark.createDataFrame([('{"a": 1}',)], "payload string")
    for compact in (False, True):
        land(envelope(responses, "api"), str(tmp_path), compact=compact)
    assert spark.read.text(str(tmp_path)).count() == 2


def test_times_do_not_depend_on_the_session_zone(spark):
    at = datetime(2024, 6, 30, 23, 30, 0, 123000, tzinfo=timezone.utc)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            clock = utc_wall_clock(F.lit(at))
            row = spark.range(1).select(iso_utc(clock), day_label(clock)).first()
            assert tuple(row) == ("2024-06-30T23:30:00.123000+00:00", "2024_06_30")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_partition_slice(spark, tmp_path):
    for day in ("2024_01_01", "2024_01_02", "2024_01_03"):
        put(tmp_path, day, record([f"{day[:4]}-01-01T00:00"], [1.0], source=day))
    one = read_bronze(spark, str(tmp_path), SCHEMA, "2024_01_02")
    assert [r["source"] for r in one.collect()] == ["2024_01_02"]
    assert one.first()["ingestion_date"] == "2024_01_02"
    assert all("2024_01_02" in f for f in one.inputFiles())
    some = read_bronze(spark, str(tmp_path), SCHEMA, ["2024_01_01", "2024_01_03"])
    assert some.count() == 2
    assert read_bronze(spark, str(tmp_path), SCHEMA).count() == 3


def test_absent_date_is_empty_and_absent_root_an_error(spark, tmp_path):
    put(tmp_path, "2024_01_01", record(["2024-01-01T00:00"], [1.0]))
    assert read_bronze(spark, str(tmp_path), SCHEMA, "2030_01_01").count() == 0
    some = read_bronze(spark, str(tmp_path), SCHEMA, ["2024_01_01", "2030_01_01"])
    assert some.count() == 1
    with pytest.raises(AnalysisException):
        read_bronze(spark, str(tmp_path / "absent"), SCHEMA)


def test_pretty_printed_documents(spark, tmp_path):
    put(tmp_path, "2024_01_01", record(["2024-01-01T00:00"], [1.0]), name="a.json", indent=2)
    put(tmp_path, "2024_01_01", record(["2024-01-01T01:00"], [2.0]), name="b.json", indent=2)
    put(tmp_path, "2024_01_01", '{"source": "s", "payload": {"hou', name="c.json")
    bronze = read_bronze(spark, str(tmp_path), SCHEMA, documents=True)
    assert flatten(bronze, SPEC).count() == 2
    assert health(bronze) == (3, 1, 0)


def test_corrupt_and_empty_records_are_counted(spark, tmp_path):
    put(
        tmp_path,
        "2024_01_01",
        record(["2024-01-01T00:00"], [1.0]),
        '{"source": "s", "payload": {"hourly": {"time": ["2024',
        record([], []),
        {"source": "s", "payload": {}},
    )
    bronze = read_bronze(spark, str(tmp_path), SCHEMA)
    assert health(bronze) == (4, 1, 2)
    assert flatten(bronze, SPEC).count() == 1


def test_only_declared_fields_are_parsed(spark, tmp_path):
    put(tmp_path, "2024_01_01", record(["2024-01-01T00:00"], [1.0]))
    fields = read_bronze(spark, str(tmp_path), SCHEMA).schema["payload"].dataType
    assert fields["hourly"].dataType.names == ["time", "temperature_2m", "wind_speed_10m"]


def test_proposed_declaration(spark, tmp_path):
    put(tmp_path, "2024_01_01", record(["2024-01-01T00:00"], [1.5], [2]))
    spec = propose_flatten(spark, str(tmp_path), "payload.hourly")
    assert spec.measures == {"temperature_2m": "temperature_2m", "wind_speed_10m": "wind_speed_10m"}
    assert [spec.type_of(n).simpleString() for n in sorted(spec.measures)] == ["double", "bigint"]
    rows = flatten(read_bronze(spark, str(tmp_path), bronze_schema(spec)), spec)
    assert rows.first().wind_speed_10m == 2
    with pytest.raises(ValueError, match="payload.daily"):
        propose_flatten(spark, str(tmp_path), "payload.daily")
    with pytest.raises(ValueError, match="No array hour"):
        propose_flatten(spark, str(tmp_path), "payload.hourly", axis="hour")


def test_one_unreadable_element_leaves_its_neighbours(spark, tmp_path):
    put(tmp_path, "2024_01_01", record(["a", "b", "c"], [1.0, "n/a", 3.0], [True, 2.0, {"x": 1}]))
    rows = flatten(read_bronze(spark, str(tmp_path), SCHEMA), SPEC, unreadable="bad").collect()
    assert [r.temperature_2m for r in rows] == [1.0, None, 3.0]
    assert [[tuple(x) for x in r.bad] for r in rows] == [
        [("wind_speed_10m", "true")],
        [("temperature_2m", "n/a")],
        [("wind_speed_10m", '{"x": 1}')],
    ]


def test_text_lands_with_its_own_characters(spark, tmp_path):
    texts = [
        '{"a": 16.0, "n": 12345678901234567890123456789012345678901234567890}',
        '{\n  "b": "\\u00e9",\r\n "a": []\n}',
        '{"cut": [1,',
        "",
        '{"k": 1, "k": 2}',
        None,
    ]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "payload string, i int")
    land(envelope(df, "s", F.struct("i")), str(tmp_path))
    lines = {
        json.loads(r.value)["request_params"]["i"]: r.value
        for r in spark.read.text(str(tmp_path)).collect()
    }
    assert len(lines) == len(texts)
    assert lines[0].endswith(f'"payload":{texts[0]}}}')
    assert lines[1].endswith('"payload":{   "b": "\\u00e9",   "a": [] }}')
    for i in (2, 3, 4, 5):
        assert json.loads(lines[i])["payload"] == texts[i]


def test_ingestion_dates_are_listed(spark, tmp_path):
    for date in ("2024_01_02", "2024_01_01"):
        put(tmp_path, date, record([], []))
    assert ingestion_dates(spark, str(tmp_path)) == ["2024_01_01", "2024_01_02"]
    assert ingestion_dates(spark, str(tmp_path / "absent")) == []
