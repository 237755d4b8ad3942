"""One function per operator: (spark, folder of the tables) to DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tideline.operators import audit
from tideline.operators.aggregate import aggregate
from tideline.operators.dedupe import dedupe_latest, distinct_keys
from tideline.operators.flatten import conform, flatten, project_arrays
from tideline.operators.inspect import sample
from tideline.operators.quality import (
    QualityError,
    duplicate_keys,
    layer_report,
    quality_report,
    route,
)
from tideline.functions.scalars import date_of, iso_utc, utc_wall_clock
from tideline.plans.incremental import keys_in_several, upsert
from tideline.plans.run import RunSpec, run
from tideline.plans.weather import weather_run
from tideline.sources.bronze import (
    INGESTION_DATE,
    bronze_schema,
    envelope,
    ingestion_dates,
    land,
    raw_path,
    read_bronze,
    record_health,
)
from tideline.sources.runlog import RunLog
from tideline.sources.sinks import (
    StoreMismatch,
    create_file,
    exists,
    fingerprint,
    gather,
    read_table,
    scratch_path,
    verify,
    write_partitioned,
)
from tideline.sources.tables import ParquetTable
from tideline.specs import GoldSpec, Measure, QualityRules, Range
from tideline.streaming.intake import intake
from workloads import events as ev

BY_DATE = ["weather_date"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__.removesuffix("_query")] = query
    return query


# --- bronze -----------------------------------------------------------------


@register
def bronze_land_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = F.col("payload.hourly")
    return ev.bronze(spark, sf_dir).select(
        "source",
        "ingestion_timestamp_utc",
        INGESTION_DATE,
        F.size(hourly["time"]).cast("bigint").alias("entries"),
        F.array_min(hourly["event_id"].cast("array<bigint>")).alias("first_event"),
        F.array_max(hourly["event_id"].cast("array<bigint>")).alias("last_event"),
    )


@register
def bronze_scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        ev.bronze(spark, sf_dir)
        .groupBy(INGESTION_DATE)
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.sum(F.size("payload.hourly.time")).alias("entries"),
        )
    )


@register
def bronze_scan_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = ev.bronze(spark, sf_dir, ingestion_date="2024_01_15")
    return day.select("source", "ingestion_timestamp_utc", INGESTION_DATE)


@register
def bronze_record_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncated lines and responses without entries are counted, not lost."""
    hourly = F.col("payload.hourly")
    emptied = F.struct(
        F.struct(
            F.when(F.col("source") == "view", F.array().cast("array<string>"))
            .otherwise(hourly["time"])
            .alias("time"),
            hourly["value"].alias("value"),
            hourly["event_id"].alias("event_id"),
        ).alias("hourly")
    )
    line = F.to_json(F.struct("ingestion_timestamp_utc", "source", "payload"))
    path = scratch_path(spark, "bronze")
    lines = (
        ev.records(spark, sf_dir)
        .withColumn("payload", emptied)
        .withColumn("line", line)
        .select(
            F.when(F.col("source") == "error", F.expr("left(line, length(line) - 3)"))
            .otherwise(F.col("line"))
            .alias("value"),
            INGESTION_DATE,
        )
    )
    gather(lines, [INGESTION_DATE]).write.partitionBy(INGESTION_DATE).text(path)
    return record_health(read_bronze(spark, path, bronze_schema(ev.FLATTEN)), ev.FLATTEN)


@register
def bronze_unreadable_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some elements of an array are no numbers; their neighbours survive."""
    hourly = F.col("payload.hourly")
    values = F.transform(
        F.arrays_zip(hourly["value"].alias("value"), hourly["event_id"].alias("event_id")),
        lambda x: F.when(x["event_id"] % 7 == 3, F.lit("n/a")).otherwise(
            x["value"].cast("string")
        ),
    )
    payload = F.struct(
        F.struct(
            hourly["time"].alias("time"), values.alias("value"), hourly["event_id"].alias("event_id")
        ).alias("hourly")
    )
    path = scratch_path(spark, "bronze")
    land(ev.records(spark, sf_dir).withColumn("payload", payload), path, compact=True)
    bronze = read_bronze(spark, path, bronze_schema(ev.FLATTEN))
    rows = flatten(bronze, ev.FLATTEN, position="idx", unreadable="unreadable")
    return rows.withColumns(
        {
            "idx": F.col("idx").cast("bigint"),
            "unreadable": F.size("unreadable").cast("bigint"),
        }
    )


@register
def bronze_land_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything landed twice, half of it a third time: one copy of each response."""
    records, path = ev.records(spark, sf_dir), scratch_path(spark, "bronze")
    for part in (records, records.filter("source < 'd'"), records):
        land(part, path, compact=True, once=True)
    hourly = F.col("payload.hourly")
    return read_bronze(spark, path, bronze_schema(ev.FLATTEN)).select(
        "source",
        "ingestion_timestamp_utc",
        INGESTION_DATE,
        F.size(hourly["time"]).cast("bigint").alias("entries"),
        F.array_min(hourly["event_id"].cast("array<bigint>")).alias("first_event"),
    )


@register
def bronze_land_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses as text, some of them no JSON: every one lands with its own characters."""
    ident = F.col("event_id").cast("string")
    kind = F.col("event_id") % 5
    good = F.concat(
        F.lit('{"z": 16.0, "long": 12345678901234567890123456789012345678901234567890,'),
        F.lit(' "e": "\\u00e9\\n", "id": '),
        ident,
        F.lit("}"),
    )
    text = (
        F.when(kind == 0, F.concat(F.lit('{"hourly": [16.0, '), ident))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.concat(F.lit('{"a": 1, "a": '), ident, F.lit("}")))
        .otherwise(good)
    )
    events = ev.table(spark, sf_dir, "events").withColumn("payload", text)
    path = scratch_path(spark, "bronze")
    params = F.struct("event_id")
    land(envelope(events, F.col("event_type"), params, F.col("ts")), path, compact=True)
    line = F.col("value")
    nested = line.contains('"payload":{"z"')
    body = F.when(nested, F.regexp_extract(line, r'"payload":(.*)\}$', 1)).otherwise(
        F.get_json_object(line, "$.payload")
    )
    return spark.read.text(path).select(
        F.get_json_object(line, "$.request_params.event_id").cast("bigint").alias("event_id"),
        F.get_json_object(line, "$.source").alias("source"),
        body.alias("payload"),
        nested.alias("nested"),
    )


# --- silver -----------------------------------------------------------------


@register
def nested_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = project_arrays(ev.bronze(spark, sf_dir), ev.FLATTEN)
    return arrays.select(
        "source",
        "ingestion_timestamp_utc",
        F.size("weather_timestamp").cast("bigint").alias("entries"),
        F.get("weather_timestamp", F.lit(0)).alias("first_hour"),
        F.try_element_at("value", F.lit(1)).alias("first_value"),
        F.try_element_at("value", F.lit(-1)).alias("last_value"),
    )


@register
def flatten_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flatten(ev.bronze(spark, sf_dir), ev.FLATTEN, position="idx")
    return rows.withColumn("idx", F.col("idx").cast("bigint"))


@register
def flatten_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value is missing for one source, another has a value too many."""
    hourly = F.col("payload.hourly")
    values = (
        F.when(F.col("source") == "error", F.slice(hourly["value"], 1, F.size(hourly["value"]) - 1))
        .when(F.col("source") == "view", F.concat(hourly["value"], F.array(F.lit(-1.0))))
        .otherwise(hourly["value"])
    )
    ragged = ev.records(spark, sf_dir).withColumn(
        "payload",
        F.struct(
            F.struct(
                hourly["time"].alias("time"),
                values.alias("value"),
                hourly["event_id"].alias("event_id"),
            ).alias("hourly")
        ),
    )
    return flatten(ragged, ev.FLATTEN)


@register
def silver_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.dated(conform(flatten(ev.bronze(spark, sf_dir), ev.FLATTEN), ev.ENVIRONMENT))


def _silver(spark: SparkSession, sf_dir: str, copies: str | None = None) -> DataFrame:
    return dedupe_latest(ev.flat(spark, sf_dir), ev.KEY, ["ingestion_timestamp_utc"], copies)


@register
def dedupe_latest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.dated(_silver(spark, sf_dir, copies="copies"))


@register
def dedupe_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_keys(ev.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- quality gates ----------------------------------------------------------


@register
def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = ev.table(spark, sf_dir, "events")
    none = QualityRules()
    reports = [quality_report(events.filter("event_type = 'absent'"), none, "empty")]
    for name in ("events", "orders", "lineitem"):
        reports.append(quality_report(ev.table(spark, sf_dir, name), none, name))
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report.select("dataset", "violations", "checked", "passed")


@register
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event type has no value, another an unreadable timestamp."""
    is_view = F.col("event_type") == "view"
    text = F.when(is_view, F.lit("junk")).otherwise(F.col("ts").cast("string"))
    events = ev.table(spark, sf_dir, "events").select(
        F.nullif("event_type", F.lit("error")).alias("source"),
        "user_id",
        F.when(F.col("event_type") != "click", F.col("value")).alias("value"),
        date_of(text).alias("weather_date"),
    )
    rules = QualityRules(
        required=("source", "user_id", "value"), partition_column="weather_date"
    )
    return quality_report(events, rules).filter("gate = 'not_null'")


@register
def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(ev.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register
def dq_value_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = QualityRules(
        ranges={
            "l_quantity": Range(1, 49),
            "l_discount": Range(max=0.05),
            "l_tax": Range(min=0.02),
            "l_extendedprice": Range(),
        }
    )
    report = quality_report(ev.table(spark, sf_dir, "lineitem"), rules, "lineitem")
    return report.filter("gate = 'value_range'")


@register
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All gates on hourly rows before de-duplication."""
    return quality_report(ev.flat(spark, sf_dir), ev.STRICT_RULES, "flattened")


@register
def dq_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, path = _silver(spark, sf_dir), scratch_path(spark, "silver")
    write_partitioned(silver, path, BY_DATE)
    stored = read_table(spark, path, silver.schema)
    return layer_report(ev.records(spark, sf_dir), stored, aggregate(stored, ev.GOLD))


# --- gold -------------------------------------------------------------------


@register
def gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.dated(aggregate(_silver(spark, sf_dir), ev.GOLD))


@register
def gold_daily_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with more decimals than are published, and means of whole numbers."""
    fine = F.col("value") + F.col("event_id") / F.lit(1e6)
    spec = GoldSpec(
        {
            "avg_fine": Measure("fine", "avg"),
            "total_fine": Measure("fine", "sum"),
            "avg_event": Measure("event_id", "avg"),
        }
    )
    return ev.dated(aggregate(_silver(spark, sf_dir).withColumn("fine", fine), spec))


@register
def gold_wide_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of very different size in one group: whole cents times powers of two."""
    cents = F.round(F.col("value") * 100)
    wide = cents * F.pow(F.lit(2.0), (F.col("event_id") % 24).cast("double"))
    spec = GoldSpec(
        {"total_wide": Measure("wide", "sum"), "max_wide": Measure("wide", "max")}
    )
    return ev.dated(aggregate(_silver(spark, sf_dir).withColumn("wide", wide), spec))


@register
def gold_daily_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = ev.table(spark, sf_dir, "lineitem")
    items = items.withColumn("ship_date", date_of(F.col("l_shipdate")))
    spec = GoldSpec(
        {
            "avg_price": Measure("l_extendedprice", "avg"),
            "total_price": Measure("l_extendedprice", "sum"),
            "max_price": Measure("l_extendedprice", "max"),
            "avg_quantity": Measure("l_quantity", "avg"),
            "total_quantity": Measure("l_quantity", "sum"),
            "avg_discount": Measure("l_discount", "avg"),
            "total_lines": Measure("l_linenumber", "sum"),
        },
        keys=("ship_date",),
    )
    return ev.dated(aggregate(items, spec), "ship_date")


@register
def gold_daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = ev.table(spark, sf_dir, "orders")
    orders = orders.withColumn("order_date", date_of(F.col("o_orderdate")))
    spec = GoldSpec(
        {
            "avg_price": Measure("o_totalprice", "avg"),
            "total_price": Measure("o_totalprice", "sum"),
            "max_price": Measure("o_totalprice", "max"),
        },
        keys=("o_orderstatus", "order_date"),
    )
    return ev.dated(aggregate(orders, spec), "order_date")


# --- sinks ------------------------------------------------------------------


@register
def silver_write_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, path = _silver(spark, sf_dir), scratch_path(spark, "silver")
    write_partitioned(silver, path, BY_DATE)
    return ev.dated(read_table(spark, path, silver.schema))


@register
def gold_write_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold")
    write_partitioned(aggregate(_silver(spark, sf_dir), ev.GOLD), path, BY_DATE)
    return ev.dated(read_table(spark, path))


def _overwrite_twice(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    flat, path = ev.flat(spark, sf_dir), scratch_path(spark, "silver")
    first = F.col("weather_date") < F.lit("2024-01-16").cast("date")
    for part in (first, ~first):
        silver = dedupe_latest(flat.filter(part), ev.KEY, ["ingestion_timestamp_utc"])
        write_partitioned(silver, path, BY_DATE, mode)
    return ev.dated(read_table(spark, path, flat.schema))


@register
def overwrite_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second slice replaces the table."""
    return _overwrite_twice(spark, sf_dir, "static")


@register
def overwrite_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second slice replaces its own dates only."""
    return _overwrite_twice(spark, sf_dir, "dynamic")


@register
def upsert_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices that overlap within every date, the older one last and once more."""
    flat, path = ev.flat(spark, sf_dir), scratch_path(spark, "silver")
    hour = F.substring("weather_timestamp", 12, 2)
    for part in (hour >= "06", hour < "12", hour < "12"):
        upsert(
            spark,
            flat.filter(part),
            path,
            ev.KEY,
            ["ingestion_timestamp_utc"],
            "weather_date",
        )
    return ev.dated(read_table(spark, path, flat.schema))


@register
def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same slices into a table that is cut into buckets below its dates."""
    flat, path = ev.flat(spark, sf_dir), scratch_path(spark, "silver")
    hour = F.substring("weather_timestamp", 12, 2)
    for part in (hour >= "06", hour < "12", hour < "12"):
        upsert(
            spark,
            flat.filter(part),
            path,
            ev.KEY,
            ["ingestion_timestamp_utc"],
            "weather_date",
            buckets=4,
        )
    return ev.dated(spark.read.parquet(path).select(*flat.columns))


def _sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of sensors, whose newest one may be of any date."""
    return ev.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        (F.col("event_id") % 499).alias("sensor"),
        "event_id",
        "value",
        date_of(F.col("ts")).alias("weather_date"),
    )


@register
def upsert_moving_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest reading of every sensor, which leaves the date of the one before."""
    readings, path = _sensors(spark, sf_dir), scratch_path(spark, "silver")
    for third in (1, 0, 2):
        upsert(
            spark,
            readings.filter(F.col("event_id") % 3 == third),
            path,
            ["source", "sensor"],
            ["event_id"],
            "weather_date",
            moving_keys=True,
        )
    return ev.dated(spark.read.parquet(path).select(*readings.columns))


@register
def keys_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with rows on several dates, and on how many."""
    return keys_in_several(_sensors(spark, sf_dir), ["source", "sensor"], "weather_date")


@register
def verified_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read back, and whether a lost and a doubled one are noticed."""
    silver, path = _silver(spark, sf_dir), scratch_path(spark, "silver")
    seen = Observation()
    metrics = fingerprint(silver.columns, silver.schema)
    write_partitioned(silver, path, BY_DATE, observe=(seen, metrics))
    published = read_table(spark, path, silver.schema)
    verify(published, seen.get, path)
    least = published.agg(F.min("event_id")).first()[0]
    one = F.col("event_id") == least
    faults = {"lost": published.filter(~one), "doubled": published.union(published.filter(one))}
    noticed = {}
    for name, rows in faults.items():
        try:
            verify(rows, seen.get, path)
            noticed[name] = False
        except StoreMismatch:
            noticed[name] = True
    return published.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", *(F.lit(n).alias(f"{name}_noticed") for name, n in noticed.items())
    )


@register
def serving_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publishing replaces the whole serving table."""
    serving = ParquetTable(scratch_path(spark, "serving"))
    gold = aggregate(_silver(spark, sf_dir), ev.GOLD)
    serving.overwrite(gold.withColumn("environment", F.lit("stale")))
    serving.overwrite(gold)
    return ev.dated(serving.read(spark))


# --- run log ----------------------------------------------------------------


def _daily_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event type and day, failed where values left the range."""
    high = F.count_if(F.col("value") > 300)
    message = F.concat(
        F.lit("Column value has "), high.cast("string"), F.lit(" values outside range 0 to 300")
    )
    runs = (
        ev.table(spark, sf_dir, "events")
        .withColumn("hour", ev.hour_text(F.col("ts")))
        .groupBy(F.col("event_type").alias("pipeline_name"), date_of(F.col("ts")).alias("day"))
        .agg(
            ev.instant(F.min("ts")).alias("start_time"),
            ev.instant(F.max("ts")).alias("end_time"),
            F.count(F.lit(1)).alias("bronze_row_count"),
            F.count_distinct("hour").alias("silver_row_count"),
            F.when(high > 0, 0).otherwise(1).cast("bigint").alias("gold_row_count"),
            F.when(high > 0, audit.FAILED).otherwise(audit.SUCCESS).alias("status"),
            F.when(high > 0, message).otherwise("").alias("error_message"),
        )
        .withColumn("environment", F.lit(ev.ENVIRONMENT))
    )
    return runs.select(*audit.AUDIT_SCHEMA.names)


def _utc_texts(log: DataFrame) -> DataFrame:
    times = [c for c in ("start_time", "end_time") if c in log.columns]
    return log.withColumns({c: iso_utc(utc_wall_clock(F.col(c))) for c in times})


def _run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = ParquetTable(scratch_path(spark, "audit"))
    runs = _daily_runs(spark, sf_dir)
    log.append(runs.filter(F.col("status") == audit.SUCCESS))
    log.append(runs.filter(F.col("status") == audit.FAILED))
    return log.read(spark)


@register
def audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc_texts(_run_log(spark, sf_dir))


@register
def audit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc_texts(audit.history(_daily_runs(spark, sf_dir)))


@register
def audit_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs logged before, between and after two compactions by month."""
    log, runs = RunLog(scratch_path(spark, "audit")), _daily_runs(spark, sf_dir)
    day = F.dayofmonth("start_time")
    for part in (day < 10, day.between(10, 19)):
        log.append(runs.filter(part))
        log.compact(spark)
    log.append(runs.filter(day > 19))
    return _utc_texts(log.read(spark))


@register
def audit_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc_texts(audit.failures(_daily_runs(spark, sf_dir)))


@register
def audit_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc_texts(audit.latest_status(_daily_runs(spark, sf_dir)))


# --- inspection and whole runs ----------------------------------------------


@register
def sample_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = ev.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return sample(events, 10, [F.desc("value"), "event_id"])


def _run_spec(
    spark: SparkSession, sf_dir: str, land_records: bool = True, serving=ParquetTable, **options
) -> RunSpec:
    root = scratch_path(spark, "lake")
    spec = RunSpec(
        source="events",
        environment=ev.ENVIRONMENT,
        bronze=f"{root}/bronze",
        silver=f"{root}/silver",
        gold=f"{root}/gold",
        flatten=ev.FLATTEN,
        rules=options.pop("rules", ev.RULES),
        aggregations=ev.GOLD,
        serving=serving(f"{root}/serving", BY_DATE),
        audit=ParquetTable(f"{root}/audit"),
        **options,
    )
    if land_records:
        land(ev.records(spark, sf_dir), raw_path(spec.bronze, spec.source), compact=True)
    return spec


@register
def medallion_full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything landed, one run, the published summary."""
    spec = _run_spec(spark, sf_dir)
    run(spark, spec)
    return ev.dated(spec.serving.read(spark))


@register
def medallion_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed files as a stream: half of them, the rest, and then nothing new."""
    spec = _run_spec(spark, sf_dir, land_records=False)
    point, records = scratch_path(spark, "intake"), ev.records(spark, sf_dir)
    for part in ("ingestion_date < '2024_01_16'", "ingestion_date >= '2024_01_16'", "false"):
        land(records.filter(part), raw_path(spec.bronze, spec.source), compact=True)
        intake(spark, spec, point)
    return ev.dated(spec.serving.read(spark))


class _LostOnce(ParquetTable):
    """A table whose first publication is interrupted."""

    def refresh(self, touched, whole, gone=()) -> None:
        super().refresh(touched, whole, gone)
        if create_file(touched.sparkSession, f"{self.path}.interrupted", ""):
            raise InterruptedError("lost")


@register
def medallion_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is interrupted while it serves, and then goes on."""
    spec = _run_spec(spark, sf_dir, serving=_LostOnce)
    try:
        run(spark, spec, run_id="first")
    except InterruptedError:
        run(spark, spec, run_id="first")
    return ev.dated(spec.serving.read(spark))


@register
def medallion_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows out of range are set aside before they replace others; the summary has the rest."""
    rules = replace(ev.RULES, ranges=ev.STRICT_RULES.ranges)
    aside = ParquetTable(scratch_path(spark, "aside"))
    spec = _run_spec(spark, sf_dir, rules=rules, quarantine=aside, tolerance=0.99)
    run(spark, spec)
    return ev.dated(spec.serving.read(spark))


@register
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of every source were set aside, by reason."""
    rules = replace(ev.RULES, ranges=ev.STRICT_RULES.ranges)
    aside = ParquetTable(scratch_path(spark, "aside"))
    run(spark, _run_spec(spark, sf_dir, rules=rules, quarantine=aside, tolerance=0.99))
    return (
        aside.read(spark)
        .select("kind", "source", F.explode("reasons").alias("reason"))
        .groupBy("kind", "source", "reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@register
def routed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading with the rules it breaks, in one pass."""
    rules = QualityRules(("event_id",), (), {"value": Range(10, 300), "event_id": Range(5, None)})
    rows = route(ev.table(spark, sf_dir, "events").select("event_id", "value"), rules)
    return rows.withColumn("reasons", F.concat_ws(" ", "reasons"))


WEATHER_GOLD = {
    "avg_temperature": {"source_column": "temperature_2m", "aggregation": "avg"},
    "max_temperature": {"source_column": "temperature_2m", "aggregation": "max"},
    "avg_humidity": {"source_column": "relative_humidity_2m", "aggregation": "avg"},
    "total_precipitation": {"source_column": "precipitation", "aggregation": "sum"},
    "max_wind_speed": {"source_column": "wind_speed_10m", "aggregation": "max"},
}


@register
def weather_full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared weather feed, its variables taken from the events."""
    lake = scratch_path(spark, "lake")
    spec = weather_run("prod", lake, WEATHER_GOLD, ParquetTable(f"{lake}/serving"))
    land(ev.weather_records(spark, sf_dir), raw_path(spec.bronze, spec.source), compact=True)
    run(spark, spec)
    return ev.dated(spec.serving.read(spark))


@register
def weather_failed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed with temperatures out of range: recorded, and nothing published."""
    lake = scratch_path(spark, "lake")
    log, serving = ParquetTable(f"{lake}/runs"), ParquetTable(f"{lake}/serving")
    spec = weather_run("prod", lake, WEATHER_GOLD, serving, log)
    records = ev.weather_records(spark, sf_dir, hot=True)
    land(records, raw_path(spec.bronze, spec.source), compact=True)
    try:
        run(spark, spec)
    except QualityError:
        pass
    reason = F.regexp_extract("error_message", r"silver: \d+ of \d+ values[^\n]*", 0)
    return log.read(spark).select(
        "environment",
        "status",
        "bronze_row_count",
        "silver_row_count",
        "gold_row_count",
        reason.alias("reason"),
        F.lit(exists(spark, spec.silver_path) or exists(spark, serving.path)).alias("published"),
    )


def _ingestion_halves(spark: SparkSession, spec: RunSpec) -> tuple[list[str], list[str]]:
    """Ingestion dates are directories: their list is what a scheduler iterates over."""
    dates = ingestion_dates(spark, spec.bronze_path)
    return dates[: len(dates) // 2], dates[len(dates) // 2 :]


@register
def medallion_incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newer dates first, then the older ones, then the newer ones again."""
    spec = _run_spec(spark, sf_dir)
    old, new = _ingestion_halves(spark, spec)
    for dates in (new, old, new):
        run(spark, spec, dates)
    return ev.dated(spec.serving.read(spark))


@register
def medallion_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that passes its gates and one that does not, with the same data."""
    for_success = _run_spec(spark, sf_dir)
    run(spark, for_success)
    for_failure = _run_spec(spark, sf_dir, rules=ev.STRICT_RULES, pipeline_name="strict")
    try:
        run(spark, for_failure)
    except QualityError:
        pass
    log = for_success.audit.read(spark).unionByName(for_failure.audit.read(spark))
    reason = F.regexp_extract("error_message", r"silver: \d+ of \d+ values[^\n]*", 0)
    return log.select(
        "environment",
        "pipeline_name",
        "bronze_row_count",
        "silver_row_count",
        "gold_row_count",
        "status",
        reason.alias("reason"),
    )


@register
def serving_select_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two slices, the older one first: a static run keeps the second alone, an upsert both."""
    served = []
    for mode in ("static", "upsert"):
        spec = _run_spec(spark, sf_dir, mode=mode)
        dates = ingestion_dates(spark, spec.bronze_path)
        for slice_ in (dates[:-1], dates[-1:]):
            run(spark, spec, slice_)
        served.append(spec.serving.read(spark).select(F.lit(mode).alias("mode"), "*"))
    return ev.dated(served[0].unionByName(served[1]))
