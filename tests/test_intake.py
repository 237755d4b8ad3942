"""Landed files as a stream: every file once, whatever is interrupted."""

import dataclasses

import pytest

from helpers import RULES, put, record, rows, run_spec
from tideline import ParquetTable, QualityError, intake, run
from test_runs import DAY1, DAY2, FULL, hours, log_of, served, two_days


def third_day(spec):
    put(spec.bronze_path, "2024_01_03", record(hours(2, 5), [8.0], [1.0], at="2024-01-03T00:00:00+00:00"))


def silver(spark, spec):
    return rows(spark.read.parquet(spec.silver_path), "weather_timestamp")


def test_each_file_once(spark, tmp_path):
    two_days(tmp_path)
    spec = run_spec(tmp_path)
    point = str(tmp_path / "point")
    assert [r.bronze_rows for r in intake(spark, spec, point)] == [2]
    assert served(spark, spec) == FULL
    assert intake(spark, spec, point) == []
    third_day(spec)
    assert [r.bronze_rows for r in intake(spark, spec, point)] == [1]
    assert served(spark, spec) == [FULL[0], ("2024-01-02", 6.0, 9.0)]
    assert [r[3] for r in log_of(spark, spec)] == ["SUCCESS"] * 2


def test_as_many_batches_as_files(spark, tmp_path):
    two_days(tmp_path)
    spec = run_spec(tmp_path)
    third_day(spec)
    results = intake(spark, spec, str(tmp_path / "point"), max_files=1)
    assert [r.bronze_rows for r in results] == [1, 1, 1]
    other = run_spec(tmp_path / "other", bronze=spec.bronze)
    run(spark, other)
    assert silver(spark, spec) == silver(spark, other)
    assert served(spark, spec) == served(spark, other)


class Breaking(ParquetTable):
    """A serving table whose first refresh fails after it was written."""

    def refresh(self, touched, whole, gone=()):
        super().refresh(touched, whole, gone)
        flag = f"{self.path}.failed"
        try:
            open(flag, "x").close()
        except FileExistsError:
            return
        raise OSError("lost")


def test_an_interrupted_batch_is_done_again(spark, tmp_path):
    two_days(tmp_path)
    spec = run_spec(tmp_path, serving=Breaking(str(tmp_path / "serving")))
    point = str(tmp_path / "point")
    with pytest.raises(OSError, match="lost"):
        intake(spark, spec, point, max_files=1)
    third_day(spec)
    results = intake(spark, spec, point, max_files=1)
    assert [r.bronze_rows for r in results] == [1, 1, 1]
    assert served(spark, spec) == [FULL[0], ("2024-01-02", 6.0, 9.0)]
    assert [r[3] for r in log_of(spark, spec)] == ["FAILED"] + ["SUCCESS"] * 3


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """The driver was lost between the last step of a batch and Spark's note of its end."""
    two_days(tmp_path)
    aside = ParquetTable(str(tmp_path / "aside"))
    rules = dataclasses.replace(RULES, required=("weather_timestamp",))
    spec = run_spec(tmp_path, quarantine=aside, rules=rules)
    put(spec.bronze_path, DAY2, record(hours(2, 3), ["n/a"], [1.0]), name="part-1.json")
    point = tmp_path / "point"
    intake(spark, spec, str(point))
    before = silver(spark, spec), served(spark, spec), log_of(spark, spec), rows(aside.read(spark))
    for name in ("0", ".0.crc"):
        (point / "commits" / name).unlink()
    assert [r.status for r in intake(spark, spec, str(point))] == ["SUCCESS"]
    assert before == (
        silver(spark, spec), served(spark, spec), log_of(spark, spec), rows(aside.read(spark))
    )
    assert len(rows(aside.read(spark))) == 1


def test_a_replay_without_its_journal_gives_the_same_tables(spark, tmp_path):
    two_days(tmp_path)
    spec = run_spec(tmp_path)
    point = tmp_path / "point"
    intake(spark, spec, str(point), max_files=1)
    before = silver(spark, spec), served(spark, spec)
    for name in ("1", ".1.crc"):
        (point / "commits" / name).unlink()
    (point / "journal" / "batch-1").rename(tmp_path / "elsewhere")
    assert len(intake(spark, spec, str(point), max_files=1)) == 1
    assert before == (silver(spark, spec), served(spark, spec))


def test_a_batch_that_fails_a_gate_is_tried_again(spark, tmp_path):
    two_days(tmp_path)
    spec = run_spec(tmp_path)
    put(spec.bronze_path, "2024_01_03", record(hours(3, 0), [99.0]))
    point = str(tmp_path / "point")
    for _ in range(2):
        with pytest.raises(QualityError, match="1 of 5 values of temperature_2m"):
            intake(spark, spec, point)
    assert not (tmp_path / "silver").exists()
    loose = dataclasses.replace(spec, rules=dataclasses.replace(RULES, ranges={}))
    intake(spark, loose, str(tmp_path / "another"))
    assert spark.read.parquet(spec.silver_path).count() == 5


def test_files_without_entries_are_passed_over(spark, tmp_path):
    spec = run_spec(tmp_path)
    put(spec.bronze_path, DAY1, record([], []))
    point = str(tmp_path / "point")
    [result] = intake(spark, spec, point)
    assert (result.status, result.bronze_rows, result.silver_rows) == ("SUCCESS", 1, 0)
    put(spec.bronze_path, DAY2, record(hours(1, 0), [1.0], [2.0]))
    assert [r.silver_rows for r in intake(spark, spec, point)] == [1]


def test_corrupt_records_of_a_batch(spark, tmp_path):
    aside = ParquetTable(str(tmp_path / "aside"))
    spec = run_spec(tmp_path, quarantine=aside, tolerance=0.5)
    put(spec.bronze_path, DAY1, record(hours(1, 0, 1), [1.0, 99.0], [5.0, 6.0]), '{"payload": {"hour')
    [result] = intake(spark, spec, str(tmp_path / "point"))
    assert (result.corrupt_records, result.rejected_rows, result.silver_rows) == (1, 1, 1)
    kinds = rows(aside.read(spark).select("kind", "reasons"), "kind")
    assert kinds == [("record", None), ("row", ["value_range:temperature_2m"])]
