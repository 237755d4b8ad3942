"""The run log of many runs, and landings that may be repeated."""

import threading
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from helpers import record, rows, run_spec
from tideline import RunLog, run
from tideline.operators import audit
from tideline.sources.bronze import INGESTION_DATE, envelope, land
from tideline.sources.sinks import create_file, files_in, read_file
from test_runs import FULL, served, two_days


def entry(month, day, status="SUCCESS", pipeline="p"):
    at = datetime(2024, month, day, tzinfo=timezone.utc)
    return audit.AuditEntry("dev", pipeline, at, at, 1, 1, 1, status, "")


def put(spark, log, *entries):
    log.append(audit.audit_frame(spark, list(entries)))


def history(spark, log):
    return rows(audit.history(log.read(spark)))


def test_same_history_before_during_and_after(spark, tmp_path):
    log = RunLog(str(tmp_path / "log"))
    assert history(spark, log) == []
    for month in (1, 2):
        for day in (1, 2, 3):
            put(spark, log, entry(month, day))
    before = history(spark, log)
    early_reader = log.read(spark)
    assert len(before) == 6
    assert log.compact(spark) == 6
    assert history(spark, log) == before
    put(spark, log, entry(2, 9), entry(3, 1))
    middle_reader, middle = log.read(spark), history(spark, log)
    assert len(middle) == 8
    months = tmp_path / "log" / "months"
    january = {p: p.stat().st_mtime_ns for p in months.rglob("month=2024_01/*.parquet")}
    assert log.compact(spark) == 1 and log.compact(spark) == 0
    assert history(spark, log) == middle
    assert january == {p: p.stat().st_mtime_ns for p in months.rglob("month=2024_01/*.parquet")}
    assert rows(audit.history(early_reader)) == before
    assert rows(audit.history(middle_reader)) == middle
    assert log.vacuum(spark, 3600) == 0
    assert log.vacuum(spark, 0) > 0
    assert history(spark, log) == middle
    put(spark, log, entry(1, 20))
    log.compact(spark)
    assert len(history(spark, log)) == 9
    files = [p for p in (tmp_path / "log").rglob("*.parquet")]
    assert len(files) <= 8


def test_a_reader_meanwhile_sees_every_run_once(spark, tmp_path):
    log = RunLog(str(tmp_path / "log"))
    for day in range(1, 5):
        put(spark, log, entry(1, day))
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(log.read(spark).count())

    reader = threading.Thread(target=read)
    reader.start()
    for day in range(5, 9):
        put(spark, log, entry(1, day))
        log.compact(spark)
    stop.set()
    reader.join()
    assert seen and seen == sorted(seen) and set(seen) <= set(range(4, 9))


def test_an_unfinished_run_does_not_count(spark, tmp_path):
    log = RunLog(str(tmp_path / "log"))
    put(spark, log, entry(1, 1))
    put(spark, log, entry(1, 2))
    done = sorted((tmp_path / "log" / "runs").iterdir())
    (done[0] / "_SUCCESS").unlink()
    assert len(history(spark, log)) == 1
    assert log.compact(spark) == 1
    assert len(history(spark, log)) == 1


def test_two_compactions_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    log = RunLog(str(tmp_path / "log"))
    put(spark, log, entry(1, 1))
    number, manifest = log._manifest(spark)
    log.compact(spark)
    monkeypatch.setattr(RunLog, "_manifest", lambda self, spark: (number, manifest))
    with pytest.raises(RuntimeError, match="came first"):
        log.compact(spark)
    monkeypatch.undo()
    assert len(history(spark, log)) == 1


def test_runs_without_a_time_and_overwritten_logs(spark, tmp_path):
    log = RunLog(str(tmp_path / "log"))
    put(spark, log, entry(1, 1))
    log.append(log.read(spark).withColumn("start_time", F.lit(None).cast("timestamp")))
    log.compact(spark)
    assert log.read(spark).count() == 2
    log.overwrite(audit.audit_frame(spark, [entry(5, 5)]))
    put(spark, log, entry(5, 6))
    log.compact(spark)
    assert [r.start_time.month for r in log.read(spark).collect()] == [5, 5]


def test_a_run_writes_its_log(spark, tmp_path):
    two_days(tmp_path)
    log = RunLog(str(tmp_path / "log"))
    spec = run_spec(tmp_path, audit=log)
    run(spark, spec)
    log.compact(spark)
    run(spark, spec)
    assert served(spark, spec) == FULL
    assert [r.status for r in audit.history(log.read(spark)).collect()] == ["SUCCESS"] * 2


def test_small_files_are_put_in_place_once(spark, tmp_path):
    path = f"{tmp_path}/deep/x.json"
    assert create_file(spark, path, "é1") and not create_file(spark, path, "2")
    assert read_file(spark, path) == "é1"
    assert files_in(spark, f"{tmp_path}/deep", ".json") == ["x.json"]
    assert files_in(spark, f"{tmp_path}/none", ".json") == []


# --- landing -----------------------------------------------------------------------


def lines(path):
    return sorted(
        (f.parent.name[-2:], line) for f in path.rglob("*") if f.suffix in (".json", ".txt")
        for line in f.read_text().splitlines()
    )


def responses(spark, *payloads, at="2024-01-01T10:00:00.000000+00:00", day="2024_01_01"):
    return spark.createDataFrame(
        [(at, "s", p, day) for p in payloads],
        f"ingestion_timestamp_utc string, source string, payload string, {INGESTION_DATE} string",
    )


def test_landing_twice_leaves_one_copy(spark, tmp_path):
    two = responses(spark, '{"a": 1}', '{"a": 2}', '{"a": 2}', "no json")
    for _ in range(3):
        land(two, str(tmp_path), once=True)
    assert len(lines(tmp_path)) == 3
    land(responses(spark, '{"a": 1}', at="2024-01-01T10:00:01.000000+00:00"), str(tmp_path), once=True)
    land(responses(spark, '{"a": 1}', day="2024_01_02"), str(tmp_path), once=True, compact=True)
    assert [d for d, _ in lines(tmp_path)] == ["01"] * 4 + ["02"]


def test_two_responses_in_one_second_both_stay(spark, tmp_path):
    for text in ('{"a": 1}', '{"a": 2}', '{"a": 1}'):
        land(responses(spark, text), str(tmp_path), once=True)
    assert len(lines(tmp_path)) == 2


@pytest.mark.parametrize("first", [False, True])
def test_nested_records_land_alike_with_and_without_once(spark, tmp_path, first):
    hourly = spark.createDataFrame(
        [((["t", "u"], [1.5, None]),), (([], []),), (None,)],
        "payload struct<time: array<string>, v: array<double>>",
    )
    at = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    records = envelope(hourly, "s", {"n": 1}, at)
    land(records, str(tmp_path), once=first)
    before = lines(tmp_path)
    assert len(before) == 3
    land(records, str(tmp_path), once=True)
    assert lines(tmp_path) == before


def test_only_dates_of_the_lines_are_read(spark, tmp_path):
    land(responses(spark, '{"a": 1}', day="2024_01_05"), str(tmp_path), once=True)
    for file in (tmp_path / "ingestion_date=2024_01_05").glob("*.txt"):
        file.write_text("spoilt")  # its checksum no longer fits
    land(responses(spark, '{"a": 1}', day="2024_01_06"), str(tmp_path), once=True)
    with pytest.raises(Exception, match="Checksum"):
        land(responses(spark, '{"a": 1}', day="2024_01_05"), str(tmp_path), once=True)


def test_nothing_to_land(spark, tmp_path):
    none = responses(spark, "x").filter("false")
    land(none, str(tmp_path / "a"), once=True)
    land(responses(spark, "x"), str(tmp_path / "a"), once=True)
    land(none, str(tmp_path / "a"), once=True)
    assert len(lines(tmp_path / "a")) == 1
    assert record(["t"], [1.0])["source"] == "s"
