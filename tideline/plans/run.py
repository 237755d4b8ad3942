"""The full run: bronze slice to published gold, recorded in the run log."""

from __future__ import annotations

import json
import logging
import traceback
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, fields
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.aggregate import aggregate
from tideline.operators.audit import FAILED, SUCCESS, AuditEntry, audit_frame
from tideline.operators.flatten import conform, flatten
from tideline.operators.quality import (
    READABLE,
    GateResult,
    enforce,
    quality_report,
    row_gate_results,
    row_metrics,
    row_reasons,
)
from tideline.plans.incremental import (
    Merge,
    Span,
    bucketed,
    publish,
    store_merged,
    touched_rows,
    units,
    verify_published,
)
from tideline.plans.journal import Journal
from tideline.sources.bronze import (
    CORRUPT_RECORD,
    INGESTION_DATE,
    bronze_schema,
    raw_path,
    read_bronze,
    record_metrics,
)
from tideline.sources.sinks import (
    fingerprint,
    gather,
    observed,
    read_stored,
    read_table,
    scratch_path,
    verify,
)
from tideline.sources.tables import Table
from tideline.specs import FlattenSpec, GoldSpec, QualityRules

log = logging.getLogger(__name__)

# Fixed value: the envelope's version column.
INGESTED = "ingestion_timestamp_utc"
UNREADABLE = "_unreadable"
REASONS = "reasons"


@dataclass(frozen=True)
class RunSpec:
    """Everything a run needs; wrong declarations fail before Spark does any work.

    ``mode="upsert"`` merges a slice into the dates it touches, ``mode="static"``
    replaces silver, gold and serving by the slice alone. Records and values that can't
    be read fail the run before it publishes anything, unless ``quarantine`` names a table
    that takes them; then the values are NULL and the run goes on.

    Rows that break a rule fail the run as well, unless ``tolerance`` says which share of a
    slice's rows may: up to it, they go to the quarantine table with their reasons, before they
    could replace an older row, and the others are published.

    ``buckets`` cuts every date of silver into as many buckets of the key, of which a slice
    rewrites only its own. ``moving_keys`` finds the older row of a key that comes with another
    date. ``verify`` reads published rows back and compares them with those written. The
    steps of a run with a name are recorded below ``journal``, or beside silver.
    """

    source: str
    environment: str
    bronze: str
    silver: str
    gold: str
    flatten: FlattenSpec
    rules: QualityRules
    aggregations: GoldSpec
    serving: Table | None = None
    audit: Table | None = None
    # Default names of the run, the layers' tables and the partition.
    pipeline_name: str = "weather_pipeline"
    bronze_entity: str = "raw"
    silver_entity: str = "weather"
    gold_entity: str = "daily_weather_summary"
    partition_column: str = "weather_date"
    documents: bool = False
    quarantine: Table | None = None
    mode: str = "upsert"
    tolerance: float = 0.0
    verify: bool = True
    buckets: int = 0
    moving_keys: bool = False
    journal: str | None = None

    def __post_init__(self) -> None:
        if self.mode not in ("upsert", "static"):
            raise ValueError(f"Unknown run mode: {self.mode}")
        if not 0 <= self.tolerance <= 1:
            raise ValueError("The tolerance is a share of the rows, from 0 to 1")
        if self.tolerance and self.quarantine is None:
            raise ValueError("A tolerance needs a quarantine table for the rows set aside")
        if INGESTED not in self.flatten.carry:
            raise ValueError(f"Flattened rows must carry {INGESTED}")
        if not self.rules.key:
            raise ValueError("The quality rules need the primary key")
        if self.partition_column not in self.aggregations.keys:
            raise ValueError(f"Gold keys must include {self.partition_column}")
        if self.rules.partition_column not in (None, self.partition_column):
            raise ValueError(f"The quality rules name another partition: {self.rules.partition_column}")
        columns = self.silver_columns
        used = {
            "required columns": self.rules.required,
            "primary key": self.rules.key,
            "value ranges": self.rules.ranges,
            "gold keys": self.aggregations.keys,
            "gold measures": [m.source_column for m in self.aggregations.measures.values()],
        }
        for where, names in used.items():
            if unknown := sorted(set(names) - set(columns)):
                raise ValueError(f"Unknown columns in the {where}: {', '.join(unknown)}")
        twice = sorted({c for c in columns if columns.count(c) > 1})
        if twice:
            raise ValueError(f"Columns declared twice: {', '.join(twice)}")

    @property
    def silver_columns(self) -> list[str]:
        flat = self.flatten
        return [
            *flat.carry,
            flat.timestamp,
            *flat.measures,
            "environment",
            self.partition_column,
        ]

    @property
    def bronze_path(self) -> str:
        return raw_path(self.bronze, self.source, self.bronze_entity)

    @property
    def silver_path(self) -> str:
        return f"{self.silver}/{self.source}/{self.silver_entity}"

    @property
    def gold_path(self) -> str:
        return f"{self.gold}/{self.source}/{self.gold_entity}"


@dataclass
class RunResult:
    """Counts fill in as the run proceeds, so a failed run records how far it came.

    Silver and gold count what passed their gates. ``unreadable_values`` counts by
    measure what was there but could not be read, ``rejected_rows`` those that broke a rule
    and were set aside. ``duplicate_keys`` had several
    rows among the slice and the dates it touches; ``superseded_rows`` are those
    that lost to a newer one.
    """

    status: str = FAILED
    bronze_rows: int = 0
    corrupt_records: int = 0
    empty_records: int = 0
    unreadable_values: dict[str, int] = field(default_factory=dict)
    flattened_rows: int = 0
    rejected_rows: int = 0
    duplicate_keys: int = 0
    superseded_rows: int = 0
    silver_rows: int = 0
    gold_rows: int = 0
    gates: list[GateResult] = field(default_factory=list)


def _count() -> dict[str, Column]:
    return {"rows": F.count(F.lit(1))}


def _gate(result: RunResult, gates: Sequence[GateResult], rules: QualityRules) -> None:
    result.gates.extend(gates)
    enforce(gates, rules)


def _faults(measure: str) -> Column:
    """How many values of a measure could not be read."""
    of_measure = F.filter(UNREADABLE, lambda x: x["column"] == measure)
    return F.coalesce(F.sum(F.size(of_measure)), F.lit(0))


def _stored(spark: SparkSession, state: dict) -> DataFrame:
    """A table that a finished step has stored."""
    schema = T.StructType.fromJson(state["schema"])
    return spark.read.schema(schema).parquet(state["path"])


def _table_state(df: DataFrame, path: str) -> dict:
    return {"path": path, "schema": df.schema.jsonValue()}


def _span(state: dict) -> Span:
    low, high = (None if v is None else date.fromisoformat(v) for v in state["span"][:2])
    return Span(low, high, *state["span"][2:])


def _store_flat(
    spark: SparkSession, spec: RunSpec, bronze: DataFrame, result: RunResult
) -> dict:
    """Parse the JSON once, without a shuffle, into columnar rows."""
    records, rows = Observation(), Observation()
    flat = conform(
        flatten(
            observed(bronze, records, record_metrics(spec.flatten)),
            spec.flatten,
            unreadable=UNREADABLE,
        ),
        spec.environment,
        spec.flatten.timestamp,
        spec.partition_column,
    )
    flat, good, broken = bucketed(flat, spec.rules.key, spec.buckets), None, {}
    if spec.tolerance:
        flat = flat.withColumn(REASONS, row_reasons(_slice_rules(spec)))
        good = F.size(REASONS) == 0
        broken = {**row_metrics(_slice_rules(spec)), "_rejected": F.count_if(~good)}
    faults = {f"_fault_{i}": _faults(name) for i, name in enumerate(spec.flatten.measures)}
    metrics = {
        **_count(),
        **Span.metrics(spec.partition_column, spec.buckets, good),
        **faults,
        **broken,
    }
    path = scratch_path(spark, "flat")
    observed(flat, rows, metrics).write.parquet(path)
    seen = rows.get
    result.bronze_rows = records.get["records"]
    result.corrupt_records = records.get["corrupt_records"]
    result.empty_records = records.get["empty_records"]
    result.flattened_rows = seen["rows"]
    result.rejected_rows = seen.get("_rejected", 0)
    result.unreadable_values = {
        name: seen[f"_fault_{i}"] for i, name in enumerate(spec.flatten.measures)
    }
    span = Span.of(seen)
    broken = {name: seen[name] for name in broken}
    return {
        **_table_state(flat, path),
        "span": [span.low, span.high, span.nulls, list(span.buckets)],
        "broken": broken,
    }


def _slice_rules(spec: RunSpec) -> QualityRules:
    """The rules that look at one row at a time."""
    return QualityRules(spec.rules.required, (), spec.rules.ranges, spec.partition_column)


def _tolerated(spec: RunSpec, state: dict, result: RunResult) -> None:
    """Fail if more rows break a rule than the declaration allows."""
    if not result.rejected_rows:
        return
    gates = [
        g for g in row_gate_results(state["broken"], _slice_rules(spec), "slice") if g.violations
    ]
    if result.rejected_rows > spec.tolerance * result.flattened_rows:
        _gate(result, gates, spec.rules)
    result.gates.extend(gates)


def _set_aside(
    spec: RunSpec, bronze: DataFrame, flat: DataFrame, result: RunResult, started: datetime
) -> None:
    """Unreadable records, unreadable values and rows that break a rule to the quarantine table."""
    carried = [F.col(c).cast("string").alias(c) for c in spec.flatten.carry]
    reasons = [F.lit(None).cast("array<string>").alias(REASONS)] if spec.tolerance else []
    records = bronze.filter(F.col(CORRUPT_RECORD).isNotNull()).select(
        F.lit("record").alias("kind"),
        INGESTION_DATE,
        *carried,
        F.lit(None).cast("string").alias(spec.flatten.timestamp),
        F.lit("").alias("column"),
        F.col(CORRUPT_RECORD).alias("content"),
        *reasons,
    )
    no_date = F.lit(None).cast("string").alias(INGESTION_DATE)
    values = (
        flat.filter(F.size(UNREADABLE) > 0)
        .select(*spec.flatten.carry, spec.flatten.timestamp, F.explode(UNREADABLE).alias("x"))
        .select(
            F.lit("value").alias("kind"),
            no_date,
            *carried,
            spec.flatten.timestamp,
            F.col("x.column").alias("column"),
            F.col("x.text").alias("content"),
            *reasons,
        )
    )
    rejected = [(records, result.corrupt_records), (values, sum(result.unreadable_values.values()))]
    if spec.tolerance:
        rows = flat.filter(F.size(REASONS) > 0).select(
            F.lit("row").alias("kind"),
            no_date,
            *carried,
            spec.flatten.timestamp,
            F.lit("").alias("column"),
            F.to_json(F.struct(*spec.silver_columns)).alias("content"),
            REASONS,
        )
        rejected.append((rows, result.rejected_rows))
    tables = [df for df, n in rejected if n]
    if not tables:
        return
    # One append, so that a run's rows are there together or not at all.
    together = tables[0]
    for df in tables[1:]:
        together = together.unionByName(df)
    spec.quarantine.append(
        together.select(
            F.lit(spec.pipeline_name).alias("pipeline_name"),
            F.lit(started).alias("run_started"),
            "*",
        )
    )


def _readable(result: RunResult) -> list[GateResult]:
    """Gates on what could not be read: whole records, then values by measure."""
    gates = [GateResult("bronze", READABLE, "", result.corrupt_records, result.bronze_rows)]
    return gates + [
        GateResult("bronze", READABLE, name, n, result.flattened_rows)
        for name, n in result.unreadable_values.items()
    ]


def _merge(spark: SparkSession, spec: RunSpec, flat: DataFrame, span: Span) -> Merge:
    existing = None
    if spec.mode == "upsert":
        by = units(spec.partition_column, spec.buckets)
        existing = read_stored(spark, spec.silver_path, flat.schema, by)
    return Merge(
        flat,
        existing,
        spec.silver_path,
        spec.rules.key,
        spec.partition_column,
        spec.buckets,
        spec.moving_keys,
        span,
    )


def _store_silver(
    spark: SparkSession, spec: RunSpec, flat: DataFrame, span: Span, result: RunResult
) -> dict:
    """Newest row per key of all touched partitions, stored aside and checked."""
    merge = _merge(spark, spec, flat, span)
    # As an instant: texts of different zones don't sort by time.
    silver = merge.rows([F.col(INGESTED).try_cast("timestamp")], copies="_copies")
    # No key gate: the rows were just reduced to one per key.
    rules = _slice_rules(spec)
    rules = QualityRules(rules.required, (), rules.ranges, spec.rules.partition_column)
    metrics = {
        **row_metrics(rules),
        "duplicate_keys": F.count_if(F.col("_copies") > 1),
        "superseded_rows": F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)),
    }
    path = scratch_path(spark, "merged")
    stored, counts = store_merged(silver, spec.partition_column, metrics, ["_copies"], path)
    result.duplicate_keys = counts["duplicate_keys"]
    result.superseded_rows = counts["superseded_rows"]
    _gate(result, row_gate_results(counts, rules, "silver"), rules)
    result.silver_rows = counts["rows"]
    found = merge.span
    return {
        **_table_state(stored, path),
        "counts": {k: counts[k] for k in ("_rows", "_sum", "_xor")},
        "span": [found.low, found.high, found.nulls, list(found.buckets), list(found.elsewhere)],
        "gone": merge.gone(stored),
    }


def _publish_silver(
    spark: SparkSession, spec: RunSpec, flat: DataFrame, silver: DataFrame, state: dict
) -> None:
    span = _silver_span(state)
    mode = "dynamic" if spec.mode == "upsert" else "static"
    merge = Merge(
        flat,
        None,
        spec.silver_path,
        spec.rules.key,
        spec.partition_column,
        spec.buckets,
        spec.moving_keys,
        span,
    )
    merge.publish(silver, mode, state["gone"])
    if spec.verify:
        verify_published(
            silver,
            spec.silver_path,
            spec.partition_column,
            state["counts"],
            span if mode == "dynamic" else None,
        )


def _silver_span(state: dict) -> Span:
    span = _span(state)
    others = [date.fromisoformat(v) for v in state["span"][4]]
    return Span(span.low, span.high, span.nulls, state["span"][3], others)


def _touched_dates(
    spark: SparkSession, spec: RunSpec, silver: DataFrame, state: dict
) -> DataFrame:
    """Published rows of all dates that the merge touched, or the merged rows if they are that.

    Where a slice replaces buckets, a date's summary needs the buckets beside them.
    """
    if not spec.buckets or spec.mode == "static":
        return silver
    published = read_stored(
        spark, spec.silver_path, silver.schema, units(spec.partition_column, spec.buckets)
    )
    span = _silver_span(state)
    gone = spark.createDataFrame(
        [(values[spec.partition_column],) for values in state["gone"]], "d string"
    ).select(F.col("d").cast("date").alias(spec.partition_column))
    dates = silver.select(spec.partition_column).unionByName(gone)
    return touched_rows(
        published, dates, spec.partition_column, Span(span.low, span.high, span.nulls, (), span.elsewhere)
    )


def _store_gold(
    spark: SparkSession, spec: RunSpec, silver: DataFrame, state: dict, result: RunResult
) -> dict:
    """Summary of the touched dates, stored aside and checked.

    If the stored summary has other columns than the declared one, all dates are
    summarised again: a summary of which only some dates know a measure is not published.
    """
    mode = "dynamic" if spec.mode == "upsert" else "static"
    rows = _touched_dates(spark, spec, silver, state)
    gold = aggregate(rows, spec.aggregations)
    before = read_table(spark, spec.gold_path, missing_ok=True) if mode == "dynamic" else None
    if before is not None and set(before.columns) != set(gold.columns):
        log.warning("The summary's columns changed; all dates are computed again")
        by = units(spec.partition_column, spec.buckets)
        rows = read_stored(spark, spec.silver_path, silver.schema, by)
        gold, mode = aggregate(rows, spec.aggregations), "static"
    seen, path = Observation(), scratch_path(spark, "gold")
    metrics = {**_count(), **fingerprint(gold.columns, gold.schema)}
    observed(gather(gold, [spec.partition_column]), seen, metrics).write.parquet(path)
    result.gold_rows = seen.get["rows"]
    _gate(result, row_gate_results(seen.get, QualityRules(), "gold"), QualityRules())
    counts = {k: seen.get[k] for k in ("_rows", "_sum", "_xor")}
    return {**_table_state(gold, path), "mode": mode, "counts": counts}


def _publish_gold(spark: SparkSession, spec: RunSpec, state: dict, silver_state: dict) -> list[dict]:
    """The stored summary into place; returns the dates that have none any more."""
    stored, mode = _stored(spark, state), state["mode"]
    gone = [] if mode == "static" else _gone_dates(spark, spec, stored, silver_state)
    publish(stored, spec.gold_path, spec.partition_column, mode, gone)
    if spec.verify:
        published = read_table(spark, spec.gold_path, stored.schema)
        if mode == "dynamic":
            published = touched_rows(
                published, stored, spec.partition_column, _dates_span(silver_state)
            )
        verify(published, state["counts"], spec.gold_path)
    return gone


def _dates_span(silver_state: dict) -> Span:
    span = _silver_span(silver_state)
    return Span(span.low, span.high, span.nulls, (), span.elsewhere)


def _gone_dates(
    spark: SparkSession, spec: RunSpec, gold: DataFrame, silver_state: dict
) -> list[dict]:
    """Dates of emptied partitions that no other bucket has rows of."""
    column = spec.partition_column
    dates = sorted({v[column] for v in silver_state["gone"] if v[column] is not None}, key=str)
    if not dates:
        return []
    left = gold.filter(F.col(column).isin([date.fromisoformat(str(d)) for d in dates]))
    there = {str(r[0]) for r in left.select(column).distinct().collect()}
    return [{column: str(d)} for d in dates if str(d) not in there]


def _serve(spark: SparkSession, spec: RunSpec, state: dict, gone: list[dict]) -> None:
    if spec.serving is None:
        return
    stored = _stored(spark, state)
    if state["mode"] == "static":
        spec.serving.overwrite(stored)
    else:
        whole = read_table(spark, spec.gold_path, stored.schema)
        spec.serving.refresh(stored, whole, gone) if gone else spec.serving.refresh(stored, whole)


class _Steps:
    """The steps of one run: each is done once, and leaves the result so far in the journal."""

    def __init__(self, journal: Journal, result: RunResult) -> None:
        self.journal, self.result = journal, result

    def do(self, name: str, work: Callable[[], dict | None]) -> dict:
        found = self.journal.get(name)
        if found is None:
            state = work() or {}
            found = self.journal.record(name, {"state": state, "result": asdict(self.result)})
            return _plain(found["state"])
        gates = [GateResult(**g) for g in found["result"]["gates"]]
        for f in fields(RunResult):
            setattr(self.result, f.name, gates if f.name == "gates" else found["result"][f.name])
        return found["state"]


def _plain(state: dict) -> dict:
    """A state as the journal would give it back."""
    return json.loads(json.dumps(state, default=str))


def _process(
    spark: SparkSession,
    spec: RunSpec,
    bronze: DataFrame,
    steps: _Steps,
    started: datetime,
    nothing_ok: bool = False,
) -> bool:
    """All steps up to serving; False if there was nothing and that is no fault."""
    result, nothing = steps.result, QualityRules()
    state = steps.do("flat", lambda: _store_flat(spark, spec, bronze, result))
    if nothing_ok and not (result.flattened_rows or result.corrupt_records):
        return False
    flat = _stored(spark, state)
    if result.empty_records:
        log.warning("%d bronze records have no entries", result.empty_records)
    if spec.quarantine is None:
        _gate(result, _readable(result), nothing)
    else:
        _tolerated(spec, state, result)
        result.gates.extend(_readable(result))
        steps.do("set_aside", lambda: _set_aside(spec, bronze, flat, result, started))
        if nothing_ok and result.flattened_rows == result.rejected_rows:
            return False
    if spec.tolerance:
        flat = flat.filter(F.size(REASONS) == 0).drop(REASONS)
    for dataset, rows in (
        ("bronze", result.bronze_rows),
        ("flattened", result.flattened_rows - result.rejected_rows),
    ):
        _gate(result, row_gate_results({"rows": rows}, nothing, dataset), nothing)
    flat, span = flat.drop(UNREADABLE), _span(state)
    found = steps.do("silver", lambda: _store_silver(spark, spec, flat, span, result))
    silver = _stored(spark, found)
    steps.do("silver_published", lambda: _publish_silver(spark, spec, flat, silver, found))
    gold = steps.do("gold", lambda: _store_gold(spark, spec, silver, found, result))
    gone = steps.do(
        "gold_published", lambda: {"gone": _publish_gold(spark, spec, gold, found)}
    )["gone"]
    steps.do("served", lambda: _serve(spark, spec, gold, gone))
    return True


def _rejected(result: RunResult) -> str:
    """What the run log says of a run that set something aside; else nothing."""
    values = sum(result.unreadable_values.values())
    if not result.corrupt_records and not values and not result.rejected_rows:
        return ""
    rows = f", {result.rejected_rows} rows" if result.rejected_rows else ""
    return f"Set aside: {result.corrupt_records} records, {values} values{rows}"


def _record(
    spark: SparkSession, spec: RunSpec, started: datetime, result: RunResult, error: str = ""
) -> None:
    if spec.audit is None:
        return
    entry = AuditEntry(
        spec.environment,
        spec.pipeline_name,
        started,
        datetime.now(timezone.utc),
        result.bronze_rows,
        result.silver_rows,
        result.gold_rows,
        result.status,
        error,
    )
    spec.audit.append(audit_frame(spark, [entry]))


def run(
    spark: SparkSession,
    spec: RunSpec,
    ingestion_date: str | Sequence[str] | None = None,
    run_id: str | None = None,
) -> RunResult:
    """Process one ingestion date, several, or everything.

    Every gate on silver is evaluated before silver is replaced. Success and failure
    are both recorded; a failing run log does not hide the error of the run.

    A run with a ``run_id`` keeps a journal of its finished steps on shared storage. Called
    again with that name, after its driver was lost, it goes on from the last finished
    step and the tables that were stored then; once it has succeeded it does nothing more.
    """
    journal = Journal(spark, None)
    if run_id is not None:
        journal = Journal.of_run(spark, spec.journal or f"{spec.silver_path}_runs", run_id)
    schema = bronze_schema(spec.flatten)
    return run_records(
        spark,
        spec,
        lambda: read_bronze(spark, spec.bronze_path, schema, ingestion_date, spec.documents),
        journal,
    )


def run_records(
    spark: SparkSession,
    spec: RunSpec,
    bronze: Callable[[], DataFrame],
    journal: Journal,
    nothing_ok: bool = False,
) -> RunResult:
    """A run over given bronze records; ``nothing_ok`` lets an empty slice pass unrecorded."""
    result = RunResult()
    steps = _Steps(journal, result)
    begun = journal.once("started", lambda: {"at": datetime.now(timezone.utc).isoformat()})
    started = datetime.fromisoformat(begun["at"])
    try:
        if not _process(spark, spec, bronze(), steps, started, nothing_ok):
            result.status = SUCCESS
            return result

        def succeed() -> None:
            result.status = SUCCESS
            _record(spark, spec, started, result, _rejected(result))

        steps.do("recorded", succeed)
    except Exception:
        result.status = FAILED
        try:
            _record(spark, spec, started, result, traceback.format_exc())
        except Exception:
            log.exception("The failed run could not be recorded")
        raise
    return result


def key_report(spark: SparkSession, spec: RunSpec) -> DataFrame:
    """All gates, uniqueness of the key included, on published silver."""
    silver = read_table(spark, spec.silver_path)
    return quality_report(silver, spec.rules)
