import dataclasses
from datetime import datetime, timezone

import pytest

from helpers import GOLD, RULES, put, record, rows, run_spec
from tideline import ParquetTable, QualityError, run, upsert
from tideline.operators import audit
from tideline.plans.incremental import keys_in_several
from tideline.plans.run import key_report
from tideline.specs import GoldSpec, Measure, QualityRules, Range

DAY1, DAY2 = "2024_01_01", "2024_01_02"


def hours(day: int, *numbers):
    return [f"2024-01-{day:02d}T{n:02d}:00" for n in numbers]


def two_days(root):
    """Day 2 brings a correction of day 1's last hour."""
    bronze = f"{root}/bronze/src/raw"
    put(bronze, DAY1, record(hours(1, 0, 1, 2), [1.0, 2.0, 3.0], [5.0, 6.0, 7.0]))
    put(
        bronze,
        DAY2,
        record(
            hours(1, 2) + hours(2, 0),
            [30.0, 4.0],
            [8.0, 9.0],
            at="2024-01-02T00:00:00.000000+00:00",
        ),
    )


FULL = [("2024-01-01", 11.0, 8.0), ("2024-01-02", 4.0, 9.0)]


def served(spark, spec):
    df = spec.serving.read(spark).selectExpr("string(weather_date)", "avg_temperature", "max_wind")
    return rows(df, "weather_date")


def log_of(spark, spec):
    return rows(
        spec.audit.read(spark)
        .orderBy("start_time")
        .select("bronze_row_count", "silver_row_count", "gold_row_count", "status")
    )


def test_full_run(spark, tmp_path):
    two_days(tmp_path)
    spec = run_spec(tmp_path)
    result = run(spark, spec)
    assert served(spark, spec) == FULL
    assert (result.bronze_rows, result.flattened_rows) == (2, 5)
    assert (result.silver_rows, result.gold_rows) == (4, 2)
    assert (result.duplicate_keys, result.superseded_rows) == (1, 1)
    assert spark.read.parquet(spec.silver_path).columns == [
        "ingestion_timestamp_utc",
        "source",
        "weather_timestamp",
        "temperature_2m",
        "wind_speed_10m",
        "environment",
        "weather_date",
    ]
    assert log_of(spark, spec) == [(2, 4, 2, "SUCCESS")]
    assert key_report(spark, spec).filter("not passed").count() == 0
    entry = spec.audit.read(spark).first()
    assert entry["error_message"] == "" and entry["pipeline_name"] == "weather_pipeline"


@pytest.mark.parametrize(
    "order", [(DAY1, DAY2, DAY2), (DAY2, DAY1), (DAY1, DAY2, DAY1), ([DAY1, DAY2],)]
)
def test_slices_in_any_order_give_the_full_run(spark, tmp_path, order):
    two_days(tmp_path)
    spec = run_spec(tmp_path)
    for dates in order:
        run(spark, spec, dates)
    assert served(spark, spec) == FULL


def test_static_mode_keeps_the_last_slice_only(spark, tmp_path):
    two_days(tmp_path)
    spec = run_spec(tmp_path, mode="static")
    run(spark, spec, DAY1)
    run(spark, spec, DAY2)
    assert served(spark, spec) == [("2024-01-01", 30.0, 8.0), ("2024-01-02", 4.0, 9.0)]


def test_two_environments_share_a_silver_table(spark, tmp_path):
    two_days(tmp_path)
    for name in ("dev", "test", "dev"):
        run(spark, run_spec(tmp_path, environment=name))
    spec = run_spec(tmp_path)
    assert served(spark, spec) == [FULL[0], FULL[0], FULL[1], FULL[1]]


def test_failed_gate_publishes_nothing_and_is_recorded(spark, tmp_path):
    two_days(tmp_path)
    spec = run_spec(tmp_path)
    run(spark, spec, DAY1)
    before = rows(spark.read.parquet(spec.silver_path), "weather_timestamp")
    put(spec.bronze_path, "2024_01_03", record(hours(1, 0) + hours(3, 0), [1.0, 99.0]))
    with pytest.raises(QualityError, match="1 of 4 values of temperature_2m lie outside") as error:
        run(spark, spec, "2024_01_03")
    assert [g.gate for g in error.value.results if not g.passed] == ["value_range"]
    assert rows(spark.read.parquet(spec.silver_path), "weather_timestamp") == before
    assert [r[3] for r in log_of(spark, spec)] == ["SUCCESS", "FAILED"]
    failure = audit.failures(spec.audit.read(spark)).first()
    assert "Traceback" in failure["error_message"]


def test_null_date_stops_the_run_before_the_write(spark, tmp_path):
    spec = run_spec(tmp_path)
    put(spec.bronze_path, DAY1, record(["junk"], [1.0]))
    with pytest.raises(QualityError, match="1 rows lack weather_date"):
        run(spark, spec)
    assert not (tmp_path / "silver").exists()


def test_absent_date(spark, tmp_path):
    two_days(tmp_path)
    spec = run_spec(tmp_path)
    with pytest.raises(QualityError, match="no rows"):
        run(spark, spec, "2030_01_01")
    assert log_of(spark, spec) == [(0, 0, 0, "FAILED")]


def test_records_without_hours(spark, tmp_path):
    spec = run_spec(tmp_path)
    put(spec.bronze_path, DAY1, record([], []))
    with pytest.raises(QualityError, match="no rows"):
        run(spark, spec)
    assert log_of(spark, spec) == [(1, 0, 0, "FAILED")]


def test_unreadable_input_fails_the_run(spark, tmp_path):
    spec = run_spec(tmp_path)
    put(spec.bronze_path, DAY1, record(hours(1, 0), [1.0], [1.0]), '{"payload": {"hour')
    with pytest.raises(QualityError, match="bronze: 1 unreadable records"):
        run(spark, spec)
    put(spec.bronze_path, DAY2, record(hours(2, 0, 1, 2), [1.0, "n/a", 3.0], [1.0, 2.0, 3.0]))
    with pytest.raises(QualityError, match="bronze: 1 unreadable values of temperature_2m"):
        run(spark, spec, DAY2)
    assert not (tmp_path / "silver").exists()
    assert [r[3] for r in log_of(spark, spec)] == ["FAILED"] * 2


def test_quarantine_takes_unreadable_input(spark, tmp_path):
    aside = ParquetTable(str(tmp_path / "aside"))
    rules = dataclasses.replace(RULES, required=("weather_timestamp",))
    spec = run_spec(tmp_path, quarantine=aside, rules=rules)
    broken = '{"payload": {"hour'
    put(
        spec.bronze_path,
        DAY1,
        record(hours(1, 0, 1, 2), [1.0, "n/a", 3.0], [5.0, 6.0, 7.0]),
        broken,
    )
    result = run(spark, spec)
    assert (result.corrupt_records, result.unreadable_values["temperature_2m"]) == (1, 1)
    silver = spark.read.parquet(spec.silver_path).orderBy("weather_timestamp")
    found = [(r.temperature_2m, r.wind_speed_10m) for r in silver.collect()]
    assert found == [(1.0, 5.0), (None, 6.0), (3.0, 7.0)]
    kept = {(r.kind, r.column, r.content) for r in aside.read(spark).collect()}
    assert kept == {("record", "", broken), ("value", "temperature_2m", "n/a")}
    entry = spec.audit.read(spark).first()
    assert (entry.status, entry.error_message) == ("SUCCESS", "Set aside: 1 records, 1 values")


def test_a_failing_log_does_not_hide_the_error(spark, tmp_path):
    class Broken(ParquetTable):
        def append(self, df):
            raise OSError("log is down")

    spec = run_spec(tmp_path, audit=Broken(str(tmp_path / "audit")))
    put(spec.bronze_path, DAY1, record(["junk"], [1.0]))
    with pytest.raises(QualityError):
        run(spark, spec)


def test_wrong_declarations_are_refused_up_front(tmp_path):
    with pytest.raises(ValueError, match="run mode"):
        run_spec(tmp_path, mode="append")
    with pytest.raises(ValueError, match="primary key"):
        run_spec(tmp_path, rules=QualityRules())
    with pytest.raises(ValueError, match="Gold keys"):
        run_spec(tmp_path, aggregations=dataclasses.replace(GOLD, keys=("source",)))
    typo = Measure("typo", "avg")
    wrong = {
        "required columns: typo": {"rules": dataclasses.replace(RULES, required=("typo",))},
        "primary key: typo": {"rules": dataclasses.replace(RULES, key=("typo",))},
        "value ranges: typo": {"rules": dataclasses.replace(RULES, ranges={"typo": Range(0)})},
        "gold keys: typo": {
            "aggregations": dataclasses.replace(GOLD, keys=("weather_date", "typo"))
        },
        "gold measures: typo": {"aggregations": GoldSpec({"x": typo})},
        "another partition": {"rules": dataclasses.replace(RULES, partition_column="day")},
    }
    for message, options in wrong.items():
        with pytest.raises(ValueError, match=message):
            run_spec(tmp_path, **options)


@pytest.mark.parametrize("date", ["2024_01_*", "2024-01-01", "", "2024_1_1"])
def test_malformed_dates_are_refused(spark, tmp_path, date):
    two_days(tmp_path)
    with pytest.raises(ValueError, match="YYYY_MM_DD"):
        run(spark, run_spec(tmp_path), [DAY1, date])


def test_a_result_does_not_depend_on_other_partitions(spark, tmp_path):
    """A row outside the rules, accepted earlier, on a date between those of the slice."""
    loose = run_spec(tmp_path, rules=dataclasses.replace(RULES, ranges={}))
    put(loose.bronze_path, DAY1, record(hours(2, 0), [99.0]))
    run(spark, loose, DAY1)
    spec = run_spec(tmp_path)
    put(spec.bronze_path, DAY2, record(hours(1, 0) + hours(3, 0), [1.0, 2.0]))
    assert run(spark, spec, DAY2).silver_rows == 2


def test_versions_compare_as_instants(spark, tmp_path):
    spec = run_spec(tmp_path)
    early = record(hours(1, 0), [1.0], at="2024-01-01T12:30:00+02:00")
    late = record(hours(1, 0), [2.0], at="2024-01-01T12:00:00+00:00")
    put(spec.bronze_path, DAY1, early, late)
    run(spark, spec)
    assert spark.read.parquet(spec.silver_path).first().temperature_2m == 2.0


def test_a_changed_summary_is_computed_again(spark, tmp_path):
    two_days(tmp_path)
    run(spark, run_spec(tmp_path))
    more = GoldSpec({**GOLD.measures, "total": Measure("temperature_2m", "sum")})
    spec = run_spec(tmp_path, aggregations=more)
    run(spark, spec, DAY1)
    found = spec.serving.read(spark).selectExpr("string(weather_date)", "total")
    assert rows(found, "weather_date") == [("2024-01-01", 33.0), ("2024-01-02", 4.0)]


def test_serving_touches_only_the_slice(spark, tmp_path):
    two_days(tmp_path)
    serving = ParquetTable(str(tmp_path / "served"), ["weather_date"])
    spec = run_spec(tmp_path, serving=serving)
    run(spark, spec)

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "served").rglob("*.parquet")}

    before = files()
    put(spec.bronze_path, "2024_01_03", record(hours(2, 5), [8.0], [1.0]))
    run(spark, spec, "2024_01_03")
    after = files()
    day1 = [p for p in before if "2024-01-01" in str(p)]
    assert day1 and all(after[p] == before[p] for p in day1)
    assert not any("2024-01-02" in str(p) and p in after for p in before)
    assert served(spark, spec) == [FULL[0], ("2024-01-02", 6.0, 9.0)]


def test_a_narrower_slice_loses_no_column(spark, tmp_path):
    path = str(tmp_path / "t")
    wide = spark.createDataFrame(
        [("a", 1, "x", "d1"), ("b", 1, "y", "d1"), ("c", 1, "z", "d2")],
        "k string, v int, extra string, d string",
    )
    upsert(spark, wide, path, ["k"], ["v"], "d")
    upsert(spark, slice_of(spark, ("b", 2, "d1"), ("n", 1, "d1")), path, ["k"], ["v"], "d")
    wider = spark.createDataFrame([("c", 2, 7, "d2")], "k string, v int, more int, d string")
    upsert(spark, wider, path, ["k"], ["v"], "d")
    schema = "k string, v int, extra string, more int, d string"
    assert rows(spark.read.schema(schema).parquet(path), "k") == [
        ("a", 1, "x", None, "d1"),
        ("b", 2, "y", None, "d1"),
        ("c", 2, "z", 7, "d2"),
        ("n", 1, None, None, "d1"),
    ]


def test_keys_that_moved(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, slice_of(spark, ("a", 1, "d1"), ("b", 1, "d1")), path, ["k"], ["v"], "d")
    upsert(spark, slice_of(spark, ("a", 2, "d2")), path, ["k"], ["v"], "d")
    moved = keys_in_several(spark.read.parquet(path), ["k"], "d")
    assert rows(moved) == [("a", 2)]


def slice_of(spark, *data):
    return spark.createDataFrame(data, "k string, v int, d string")


def test_upsert_keeps_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")

    def put_slice(*data):
        return upsert(spark, slice_of(spark, *data), path, ["k"], ["v"], "d")

    assert put_slice(("a", 1, "d1"), ("b", 1, "d1"), ("c", 1, "d2"), ("n", 1, None)) == 4
    assert put_slice(("b", 2, "d1"), ("e", 1, "d3"), ("m", 1, None)) == 5
    assert put_slice(("b", 1, "d1")) == 2
    found = rows(spark.read.schema("k string, v int, d string").parquet(path), "k")
    assert found == [
        ("a", 1, "d1"),
        ("b", 2, "d1"),
        ("c", 1, "d2"),
        ("e", 1, "d3"),
        ("m", 1, None),
        ("n", 1, None),
    ]


def test_empty_slice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, slice_of(spark, ("a", 1, "d1")), path, ["k"], ["v"], "d")
    assert upsert(spark, slice_of(spark, ("a", 1, "d1")).limit(0), path, ["k"], ["v"], "d") == 0
    assert spark.read.parquet(path).count() == 1


def entry(start, status, error="", rows_=2**31, pipeline="p"):
    at = datetime(2024, 1, 1, start, tzinfo=timezone.utc)
    return audit.AuditEntry("dev", pipeline, at, at, rows_, rows_, 1, status, error)


def test_run_log_questions(spark, tmp_path):
    table = ParquetTable(str(tmp_path))
    table.append(audit.audit_frame(spark, [entry(1, "SUCCESS"), entry(3, "FAILED", "boom")]))
    more = [entry(2, "FAILED", "bang"), entry(9, "SUCCESS", pipeline="q")]
    table.append(audit.audit_frame(spark, more))
    log = table.read(spark)
    assert [r["start_time"].hour for r in audit.history(log).collect()] == [9, 3, 2, 1]
    assert "error_message" not in audit.history(log).columns
    assert audit.history(log).first()["bronze_row_count"] == 2**31
    assert [r["error_message"] for r in audit.failures(log).collect()] == ["boom", "bang"]
    latest = {r["pipeline_name"]: r["status"] for r in audit.latest_status(log).collect()}
    assert latest == {"p": "FAILED", "q": "SUCCESS"}

