"""Merges below a date, keys that move, rows set aside, read-back and resumed runs."""

import dataclasses
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import RULES, put, record, rows, run_spec
from tideline import GoldSpec, Measure, ParquetTable, QualityError, run, upsert
from tideline.plans.incremental import BUCKET, keys_in_several
from tideline.plans.journal import Journal
from tideline.plans.key_index import KeyIndex
from tideline.sources.sinks import StoreMismatch, fingerprint, verify
from test_runs import DAY1, DAY2, FULL, hours, log_of, served, two_days

SCHEMA = "k string, v int, d date"


def dated(spark, *data):
    return spark.createDataFrame([(k, v, d and date(2024, 1, d)) for k, v, d in data], SCHEMA)


def files(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def spoil(folder):
    """Make the rows of a folder's files unreadable, but not their footers."""
    for file in folder.glob("*.parquet"):
        raw = bytearray(file.read_bytes())
        end = len(raw) - 8 - int.from_bytes(raw[-8:-4], "little")
        raw[4:end] = b"\xff" * (end - 4)
        file.write_bytes(bytes(raw))
        file.with_name(f".{file.name}.crc").unlink()


def found(spark, path, *columns):
    df = spark.read.parquet(str(path)).selectExpr("k", "v", "day(d) AS d")
    return rows(df, "k", "d")


# --- keys that move between partitions ----------------------------------------


def put_moving(spark, path, *data, buckets=0):
    return upsert(
        spark, dated(spark, *data), str(path), ["k"], ["v"], "d",
        buckets=buckets, moving_keys=True, check=True,
    )


@pytest.mark.parametrize("buckets", [0, 4])
def test_a_moved_key_has_one_row(spark, tmp_path, buckets):
    path = tmp_path / "t"
    put_moving(spark, path, ("a", 1, 1), ("b", 1, 1), ("c", 1, 2), ("n", 1, None), buckets=buckets)
    put_moving(spark, path, ("a", 2, 3), ("n", 2, 2), buckets=buckets)
    assert found(spark, path) == [("a", 2, 3), ("b", 1, 1), ("c", 1, 2), ("n", 2, 2)]
    # An older version of a key that has moved does not bring it back.
    put_moving(spark, path, ("a", 1, 1), buckets=buckets)
    put_moving(spark, path, ("c", 5, None), ("b", 7, 9), buckets=buckets)
    assert found(spark, path) == [("a", 2, 3), ("b", 7, 9), ("c", 5, None), ("n", 2, 2)]
    assert rows(keys_in_several(spark.read.parquet(str(path)), ["k"], "d")) == []


def test_untouched_dates_are_not_opened(spark, tmp_path):
    path = tmp_path / "t"
    put_moving(spark, path, *((f"k{d}", 1, d) for d in range(1, 29)))
    for day in range(1, 29):
        if day not in (3, 20):
            spoil(path / f"d=2024-01-{day:02d}")
    with pytest.raises(Exception, match="(?i)parquet|corrupt|read"):
        spark.read.schema(SCHEMA).parquet(str(path)).select(F.sum("v")).collect()
    put_moving(spark, path, ("k3", 2, 20))
    kept = spark.read.schema(SCHEMA).parquet(str(path)).filter("d = date'2024-01-20'")
    assert rows(kept.select("k", "v"), "k") == [("k20", 1), ("k3", 2)]
    assert not (path / "d=2024-01-03").exists()


def test_an_index_is_made_for_a_table_that_has_none(spark, tmp_path):
    path = tmp_path / "t"
    upsert(spark, dated(spark, ("a", 1, 1), ("b", 1, 2)), str(path), ["k"], ["v"], "d")
    put_moving(spark, path, ("a", 2, 2))
    assert found(spark, path) == [("a", 2, 2), ("b", 1, 2)]


def test_a_stopped_publication_leaves_no_key_unlisted(spark, tmp_path, monkeypatch):
    """Stopped between silver and its index, then another slice moves the same keys."""
    path = tmp_path / "t"
    put_moving(spark, path, ("a", 1, 1), ("b", 1, 2))

    def lost(self, rows):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(KeyIndex, "replace", lost)
        with pytest.raises(OSError):
            put_moving(spark, path, ("c", 1, 5))
    put_moving(spark, path, ("c", 2, 6))
    assert found(spark, path) == [("a", 1, 1), ("b", 1, 2), ("c", 2, 6)]


@pytest.mark.parametrize("buckets", [0, 3])
def test_many_moves_equal_the_newest_rows(spark, tmp_path, buckets):
    draw, newest, path = random.Random(9), {}, tmp_path / "t"
    for step in range(5):
        keys = draw.sample(range(60), 20)
        slice_ = [(f"k{k}", step * 100 + draw.randrange(50), draw.choice([None, *range(1, 8)])) for k in keys]
        for k, v, d in slice_:
            newest[k] = (v, d)
        put_moving(spark, path, *slice_, buckets=buckets)
    assert found(spark, path) == sorted((k, v, d) for k, (v, d) in newest.items())
    listed = spark.read.parquet(f"{path}_keys")
    assert listed.count() == len(newest)


def test_moved_keys_leave_the_summary(spark, tmp_path):
    serving = ParquetTable(str(tmp_path / "served"), ["weather_date"])
    rules = dataclasses.replace(RULES, key=("source",))
    spec = run_spec(tmp_path, moving_keys=True, serving=serving, rules=rules)
    put(spec.bronze_path, DAY1, record(hours(1, 0), [1.0], [1.0], source="a"), record(hours(2, 0), [2.0], [1.0], source="b"))
    run(spark, spec, DAY1)
    put(spec.bronze_path, DAY2, record(hours(3, 0), [9.0], [1.0], source="a", at="2024-01-02T00:00:00+00:00"))
    run(spark, spec, DAY2)
    assert served(spark, spec) == [("2024-01-02", 2.0, 1.0), ("2024-01-03", 9.0, 1.0)]
    gold = spark.read.parquet(spec.gold_path).selectExpr("string(weather_date)")
    assert rows(gold, "weather_date") == [("2024-01-02",), ("2024-01-03",)]


# --- buckets of the key below a date --------------------------------------------


def test_a_late_row_rewrites_its_bucket_alone(spark, tmp_path):
    path = tmp_path / "t"
    many = spark.range(4000).selectExpr("concat('k', id) AS k", "1 AS v", "date'2024-01-01' AS d")
    upsert(spark, many, str(path), ["k"], ["v"], "d", buckets=16)
    before = files(path)
    assert len({p.parent for p in before}) == 16
    assert upsert(spark, dated(spark, ("k7", 2, 1)), str(path), ["k"], ["v"], "d", buckets=16) < 400
    after = files(path)
    same = [p for p in before if after.get(p) == before[p]]
    assert len({p.parent for p in same}) == 15
    size = sum(p.stat().st_size for p in after if p not in before)
    assert size < sum(p.stat().st_size for p in after) / 8
    table = spark.read.parquet(str(path))
    assert table.count() == 4000
    assert rows(table.filter("v = 2").select("k")) == [("k7",)]


def test_a_late_row_opens_its_bucket_alone(spark, tmp_path):
    path = tmp_path / "t"
    many = spark.range(400).selectExpr("concat('k', id) AS k", "1 AS v", "date'2024-01-01' AS d")
    upsert(spark, many, str(path), ["k"], ["v"], "d", buckets=8)
    mine = spark.range(1).select(F.pmod(F.xxhash64(F.lit("k7")), F.lit(8))).first()[0]
    folder = path / "d=2024-01-01"
    for b in range(8):
        if b != mine:
            spoil(folder / f"{BUCKET}={b}")
    upsert(spark, dated(spark, ("k7", 2, 1)), str(path), ["k"], ["v"], "d", buckets=8)
    kept = spark.read.schema(f"{SCHEMA}, {BUCKET} int").parquet(str(path)).filter(f"{BUCKET} = {mine}")
    assert rows(kept.filter("v = 2").select("k")) == [("k7",)]


def test_runs_with_buckets_end_like_those_without(spark, tmp_path):
    two_days(tmp_path)
    plain = run_spec(tmp_path)
    run(spark, plain)
    spec = run_spec(tmp_path, silver=f"{tmp_path}/s2", gold=f"{tmp_path}/g2", buckets=4,
                    serving=ParquetTable(f"{tmp_path}/served2"))
    for dates in (DAY2, DAY1, DAY2):
        run(spark, spec, dates)
    assert served(spark, spec) == FULL
    silver = spark.read.parquet(spec.silver_path).drop(BUCKET)
    expected = spark.read.parquet(plain.silver_path).select(*silver.columns)
    assert rows(silver, "weather_timestamp") == rows(expected, "weather_timestamp")


# --- rows that break a rule -------------------------------------------------------


def broken_day(spec):
    put(
        spec.bronze_path,
        DAY1,
        record(hours(1, 0, 1, 2) + ["junk"], [1.0, 99.0, None, 4.0], [5.0, 6.0, 7.0, 8.0]),
        record(hours(2, 0, 1, 2, 3), [1.0, 2.0, 3.0, 4.0], [1.0, 1.0, 1.0, 1.0]),
    )


def test_rows_that_break_a_rule_are_set_aside(spark, tmp_path):
    aside = ParquetTable(str(tmp_path / "aside"))
    spec = run_spec(tmp_path, quarantine=aside, tolerance=0.4)
    broken_day(spec)
    result = run(spark, spec)
    assert (result.flattened_rows, result.rejected_rows, result.silver_rows) == (8, 3, 5)
    kept = {(r.weather_timestamp, r.kind, tuple(r.reasons)) for r in aside.read(spark).collect()}
    assert kept == {
        ("2024-01-01T01:00", "row", ("value_range:temperature_2m",)),
        ("2024-01-01T02:00", "row", ("not_null:temperature_2m",)),
        ("junk", "row", ("not_null:weather_date",)),
    }
    assert '"temperature_2m":99.0' in aside.read(spark).filter("weather_timestamp LIKE '%01:00'").first().content
    assert served(spark, spec) == [("2024-01-01", 1.0, 5.0), ("2024-01-02", 2.5, 1.0)]
    entry = spec.audit.read(spark).first()
    assert (entry.status, entry.silver_row_count) == ("SUCCESS", 5)
    assert entry.error_message == "Set aside: 0 records, 0 values, 3 rows"
    failed = {(g.dataset, g.gate, g.column): g.violations for g in result.gates if not g.passed}
    assert failed[("slice", "value_range", "temperature_2m")] == 1


def test_more_broken_rows_than_tolerated_fail_the_run(spark, tmp_path):
    spec = run_spec(tmp_path, quarantine=ParquetTable(str(tmp_path / "aside")), tolerance=0.3)
    broken_day(spec)
    with pytest.raises(QualityError, match="slice: 1 rows lack"):
        run(spark, spec)
    assert not (tmp_path / "silver").exists() and not (tmp_path / "aside").exists()
    assert log_of(spark, spec) == [(2, 0, 0, "FAILED")]


def test_a_broken_row_does_not_replace_a_good_one(spark, tmp_path):
    spec = run_spec(tmp_path, quarantine=ParquetTable(str(tmp_path / "aside")), tolerance=1.0)
    two_days(tmp_path)
    run(spark, spec)
    worse = record(hours(1, 0) + hours(2, 1), [-99.0, 6.0], [5.0, 5.0], at="2024-02-01T00:00:00+00:00")
    put(spec.bronze_path, "2024_02_01", worse)
    run(spark, spec, "2024_02_01")
    assert served(spark, spec) == [FULL[0], ("2024-01-02", 5.0, 9.0)]


def test_a_tolerance_needs_somewhere_to_put_rows(tmp_path):
    with pytest.raises(ValueError, match="quarantine"):
        run_spec(tmp_path, tolerance=0.1)
    with pytest.raises(ValueError, match="from 0 to 1"):
        run_spec(tmp_path, tolerance=2, quarantine=ParquetTable("x"))


# --- read-back ------------------------------------------------------------------------


def test_fingerprint_is_free_of_order_and_sees_every_change(spark):
    df = spark.createDataFrame(
        [(1, None, "x", {"a": 1}), (2, "y", None, {}), (2, "y", None, {})],
        "i int, s string, t string, m map<string,int>",
    )

    def of(rows_):
        return rows_.agg(*(c.alias(n) for n, c in fingerprint(df.columns, df.schema).items())).first()

    assert of(df) == of(df.repartition(3)) == of(df.orderBy(F.desc("i")))
    swapped = df.select("i", F.col("t").alias("s"), F.col("s").alias("t"), "m")
    changed = [df.limit(2), df.union(df.limit(1)), swapped, df.withColumn("i", F.col("i") + 1),
               df.union(df).union(df), df.limit(0), df.withColumn("m", F.create_map(F.lit("a"), F.lit(2)))]
    assert all(of(other) != of(df) for other in changed)
    verify(df, of(df).asDict(), "t")
    with pytest.raises(StoreMismatch, match="2 rows after writing 3"):
        verify(df.limit(2), of(df).asDict(), "t")


@pytest.mark.parametrize("fault", ["lost", "doubled"])
@pytest.mark.parametrize("layer", ["silver", "gold"])
def test_a_lost_or_doubled_file_fails_the_run(spark, tmp_path, monkeypatch, fault, layer):
    import tideline.plans.incremental as incremental

    two_days(tmp_path)
    spec = run_spec(tmp_path)
    path = tmp_path / layer
    write = incremental.write_partitioned

    def faulty(df, target, *args, **options):
        write(df, target, *args, **options)
        if str(target).startswith(str(path)):
            file = sorted((p for p in path.rglob("*.parquet")))[0]
            if fault == "lost":
                file.unlink()
            else:
                file.with_name("again-" + file.name).write_bytes(file.read_bytes())

    monkeypatch.setattr(incremental, "write_partitioned", faulty)
    with pytest.raises(StoreMismatch, match="holds other rows"):
        run(spark, spec)
    assert log_of(spark, spec)[0][3] == "FAILED"
    run(spark, dataclasses.replace(spec, verify=False))


# --- resumed runs ---------------------------------------------------------------------

STEPS = ["flat", "silver", "silver_published", "gold", "gold_published", "served", "recorded"]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_a_run_stopped_at_any_step_ends_like_an_undisturbed_one(spark, tmp_path, monkeypatch, step, after):
    two_days(tmp_path)
    spec = run_spec(tmp_path)
    record_ = Journal.record

    def stop(self, name, state):
        if name == step:
            if after:
                record_(self, name, state)
            raise KeyboardInterrupt
        return record_(self, name, state)

    with monkeypatch.context() as stopped:
        stopped.setattr(Journal, "record", stop)
        with pytest.raises(KeyboardInterrupt):
            run(spark, spec, [DAY1, DAY2], run_id="r1")
    result = run(spark, spec, [DAY1, DAY2], run_id="r1")
    assert (result.status, result.silver_rows, result.gold_rows) == ("SUCCESS", 4, 2)
    assert (result.duplicate_keys, result.superseded_rows) == (1, 1)
    assert served(spark, spec) == FULL
    logged = log_of(spark, spec)
    # Stopped between the entry in the log and the journal's note of it, it is logged again.
    assert set(logged) == {(2, 4, 2, "SUCCESS")}
    assert len(logged) == (2 if step == "recorded" and not after else 1)


def test_finished_steps_are_not_done_again(spark, tmp_path, monkeypatch):
    two_days(tmp_path)
    spec = run_spec(tmp_path, journal=str(tmp_path / "journal"))
    run(spark, spec, run_id="r1")
    for file in (tmp_path / "bronze").rglob("*.json"):
        file.write_text("broken")
    before = files(tmp_path)
    assert run(spark, spec, run_id="r1").status == "SUCCESS"
    assert files(tmp_path) == before
    assert len(log_of(spark, spec)) == 1
    with pytest.raises(QualityError):
        run(spark, spec, run_id="r2")


@pytest.mark.parametrize("name", ["", "../x", "a b", ".hidden"])
def test_run_names_are_plain(spark, tmp_path, name):
    with pytest.raises(ValueError, match="A run is named"):
        run(spark, run_spec(tmp_path), run_id=name)


def test_a_changed_summary_with_buckets_and_moving_keys(spark, tmp_path):
    two_days(tmp_path)
    run(spark, run_spec(tmp_path, buckets=2, moving_keys=True))
    more = GoldSpec({"total": Measure("temperature_2m", "sum")})
    spec = run_spec(tmp_path, aggregations=more, buckets=2, moving_keys=True)
    run(spark, spec, DAY1)
    totals = spec.serving.read(spark).selectExpr("string(weather_date)", "total")
    assert rows(totals, "weather_date") == [("2024-01-01", 33.0), ("2024-01-02", 4.0)]


def test_the_index_keeps_sorted_fingerprints_small(spark, tmp_path):
    path = tmp_path / "t"
    many = spark.range(200_000).selectExpr("concat('k', id) AS k", "1 AS v", "date'2024-01-01' AS d")
    index = KeyIndex(f"{path}_keys", ["k"], ["d"])
    index.replace(many)
    kept = sum(p.stat().st_size for p in (tmp_path / "t_keys").rglob("*.parquet"))
    assert kept < 6.6 * 200_000
    assert index.read(many).count() == 200_000
