"""Shapes of the physical plans and files that matter at scale."""

import re
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from helpers import GOLD, KEY, SPEC, put, record
from tideline import GoldSpec, Measure, aggregate, dedupe_latest, flatten, quality_report
from tideline.plans.incremental import Span, touched_rows
from tideline.sources.bronze import bronze_schema, read_bronze
from tideline.sources.sinks import gather, observed, qualified, scratch_path, write_partitioned
from workloads import events as ev

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def silver(spark):
    return spark.createDataFrame(
        [],
        "ingestion_timestamp_utc string, source string, weather_timestamp string, "
        "temperature_2m double, wind_speed_10m double, environment string, weather_date date",
    )


def exchanges(text: str) -> int:
    return len(re.findall(r"Exchange (?:hash|Single|range)", text))


def test_row_gates_share_one_scan_and_no_wide_shuffle(spark):
    items = ev.table(spark, SF, "lineitem")
    rules = ev.QualityRules(
        required=("l_tax", "l_shipdate"),
        ranges={"l_tax": ev.Range(0, 1), "l_discount": ev.Range(0)},
    )
    text = plan(quality_report(items, rules))
    assert text.count("FileScan") == 1
    assert exchanges(text) == 1 and "Exchange SinglePartition" in text
    assert "ReadSchema: struct<l_discount:double,l_tax:double,l_shipdate:timestamp_ntz>" in text


def test_key_gate_adds_one_shuffle_after_partial_counts(spark):
    items = ev.table(spark, SF, "lineitem")
    rules = ev.QualityRules(required=("l_tax",), key=("l_orderkey",))
    text = plan(quality_report(items, rules))
    assert text.count("FileScan") == 1
    assert exchanges(text) == 2
    assert text.count("HashAggregate") == 4


def test_dedupe_folds_keys_before_its_only_shuffle(silver):
    text = plan(dedupe_latest(silver, KEY, ["ingestion_timestamp_utc"]))
    assert exchanges(text) == 1
    assert text.index("SortAggregate") < text.index("Exchange") < text.rindex("partial_max")


def test_gold_aggregates_by_hash(silver):
    """Partial sums of rows before the first shuffle; the second has a row a group and window."""
    text = plan(aggregate(silver, GOLD))
    assert exchanges(text) == 2
    assert text.count("HashAggregate") == 4
    assert "SortAggregate" not in text and "ObjectHash" not in text
    # From the bottom: partial, shuffle by group and window, final, shuffle by group, sort.
    order = [text.rindex("partial_count("), text.rindex("Exchange"), text.index("Exchange"), text.index("Sort [")]
    assert order == sorted(order, reverse=True)
    only_max = plan(aggregate(silver, GoldSpec({"m": Measure("wind_speed_10m", "max")})))
    assert exchanges(only_max) == 1


def test_flatten_has_no_shuffle_and_no_python(spark, tmp_path):
    put(tmp_path, "2024_01_01", record(["2024-01-01T00:00"], [1.0]))
    text = plan(flatten(read_bronze(spark, str(tmp_path), bronze_schema(SPEC)), SPEC))
    assert "Exchange" not in text and "Python" not in text
    assert re.search(r"\*\(1\) Generate posexplode", text)


def test_merge_opens_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [("a", f"2024-01-{day:02d}") for day in range(1, 10)]
    data = spark.createDataFrame(days, "k string, d string")
    table = data.select("k", F.col("d").cast("date").alias("d"))
    write_partitioned(table, path, ["d"])
    slice_ = table.filter("d IN (date'2024-01-03', date'2024-01-06')")
    low, high = slice_.selectExpr("min(d)", "max(d)").first()
    existing = spark.read.schema(table.schema).parquet(path)
    found = touched_rows(existing, slice_, "d", Span(low, high, 0))
    text = plan(found)
    assert re.search(r"PartitionFilters: \[[^\]]*d#\d+ >= 2024-01-03.*d#\d+ <= 2024-01-06", text)
    assert "isnull" not in text.replace("isnotnull", "")
    assert sorted(str(r.d) for r in found.collect()) == ["2024-01-03", "2024-01-06"]
    nothing = touched_rows(existing, slice_.limit(0), "d", Span(None, None, 0))
    assert nothing.count() == 0
    only_null = plan(touched_rows(existing, slice_, "d", Span(None, None, 2)))
    assert re.search(r"PartitionFilters: \[isnull\(d", only_null)


def test_a_hot_date_is_written_by_several_tasks(spark, tmp_path):
    """Nine rows in ten have one date; its files must not come from one task."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "512k")
    try:
        df = spark.range(0, 600_000, 1, 8).select(
            F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(99).alias("d"),
            F.sha2(F.col("id").cast("string"), 256).alias("x"),
        )
        write_partitioned(df, str(tmp_path), ["d"])
    finally:
        spark.conf.set(key, before)
    files = {int(p.name[2:]): len(list(p.glob("*.parquet"))) for p in tmp_path.glob("d=*")}
    assert set(files) == {0, 1, 2, 3, 4, 5, 6, 99}
    assert files[99] > 1
    assert spark.read.parquet(str(tmp_path)).count() == 600_000


def test_without_adaptive_execution_rows_stay_where_they_are(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_partitioned(spark.range(100).withColumn("d", F.lit(1)), str(tmp_path), ["d"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert spark.read.parquet(str(tmp_path)).count() == 100


def test_observed_counts_survive_lost_tasks(spark, tmp_path):
    """Every writing task fails once after it has counted its rows."""

    def fail_once(batches):
        from pyspark import TaskContext

        rows = list(batches)
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")
        yield from rows

    seen = Observation()
    df = gather(spark.range(1000).withColumn("d", F.col("id") % 5), ["d"])
    counted = observed(df, seen, {"rows": F.count(F.lit(1))})
    counted.mapInPandas(fail_once, df.schema).write.parquet(str(tmp_path / "t"))
    assert seen.get["rows"] == 1000
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_nothing_is_collapsed_into_one_task(spark, silver):
    for df in (dedupe_latest(silver, KEY), aggregate(silver, GOLD), ev.flat(spark, SF)):
        text = plan(df)
        assert "SinglePartition" not in text and "Coalesce" not in text


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(shared) and first != second
    assert not Path(first).exists()
    assert qualified(spark, first) == f"file://{first}"
    assert qualified(spark, f"file:{first}") == f"file://{first}"


def test_unknown_overwrite_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        write_partitioned(spark.range(1), str(tmp_path), ["id"], mode="append")

