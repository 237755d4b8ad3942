"""Data-quality gates, declared as rules and evaluated in one pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.specs import QualityRules, Range

ROW_COUNT = "row_count"
NOT_NULL = "not_null"
NO_DUPLICATES = "no_duplicates"
VALUE_RANGE = "value_range"
READABLE = "readable"


class QualityError(ValueError):
    """A declared rule does not hold; ``results`` has all gates evaluated with it."""

    def __init__(self, message: str, results: Sequence["GateResult"] = ()) -> None:
        super().__init__(message)
        self.results = list(results)


@dataclass(frozen=True)
class Gate:
    kind: str
    column: str
    metric: str


@dataclass(frozen=True)
class GateResult:
    dataset: str
    gate: str
    column: str
    violations: int
    checked: int

    @property
    def passed(self) -> bool:
        return self.violations == 0


def out_of_range(column: str, bounds: Range) -> Column:
    """Below the minimum or above the maximum. NULL is neither, NaN is above."""
    value = F.col(column)
    sides = []
    if bounds.min is not None:
        sides.append(value < bounds.min)
    if bounds.max is not None:
        sides.append(value > bounds.max)
    if not sides:
        return F.lit(False)
    return sides[0] if len(sides) == 1 else sides[0] | sides[1]


def _row_gates(rules: QualityRules) -> list[tuple[Gate, Column]]:
    """Gates that look at one row at a time, with the condition of a violation."""
    nullable = list(dict.fromkeys(rules.required))
    if rules.partition_column and rules.partition_column not in nullable:
        nullable.append(rules.partition_column)
    gates = [
        (Gate(NOT_NULL, name, f"null_{i}"), F.col(name).isNull())
        for i, name in enumerate(nullable)
    ]
    gates += [
        (Gate(VALUE_RANGE, name, f"range_{i}"), out_of_range(name, bounds))
        for i, (name, bounds) in enumerate(rules.ranges.items())
    ]
    return gates


def row_metrics(rules: QualityRules) -> dict[str, Column]:
    """Aggregates behind all row-level gates, for ``agg`` or ``observe``."""
    metrics = {"rows": F.count(F.lit(1))}
    for gate, violated in _row_gates(rules):
        metrics[gate.metric] = F.count_if(violated)
    return metrics


def row_reasons(rules: QualityRules) -> Column:
    """The row-level gates that a row fails, as texts ``gate:column``; none is an empty array."""
    broken = [F.when(violated, f"{g.kind}:{g.column}") for g, violated in _row_gates(rules)]
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def route(df: DataFrame, rules: QualityRules, reasons: str = "reasons") -> DataFrame:
    """Every row with the gates it fails, so that one pass can send it either way."""
    return df.withColumn(reasons, row_reasons(rules))


def row_gate_results(
    values: Mapping[str, int], rules: QualityRules, dataset: str
) -> list[GateResult]:
    """Gate results from observed ``row_metrics``, in the order of the report."""
    rows = int(values["rows"])
    results = [GateResult(dataset, ROW_COUNT, "", int(rows == 0), rows)]
    results += [
        GateResult(dataset, gate.kind, gate.column, int(values[gate.metric]), rows)
        for gate, _ in _row_gates(rules)
    ]
    return results


def quality_report(df: DataFrame, rules: QualityRules, dataset: str = "silver") -> DataFrame:
    """Every gate as a row ``(dataset, gate, column, violations, checked, passed)``.

    One scan serves all gates. With a key the rows are first counted per key,
    carrying the counts of the other gates along, so uniqueness costs the one
    shuffle it needs and a repeated key is folded before it.
    """
    gates = [gate for gate, _ in _row_gates(rules)]
    if rules.key:
        per_key = df.groupBy(*rules.key).agg(
            *(c.alias(f"_{name}") for name, c in row_metrics(rules).items())
        )
        totals = per_key.agg(
            *(
                F.coalesce(F.sum(f"_{name}"), F.lit(0)).alias(name)
                for name in ["rows", *(g.metric for g in gates)]
            ),
            F.count_if(F.col("_rows") > 1).alias("duplicate_keys"),
        )
        gates.append(Gate(NO_DUPLICATES, ", ".join(rules.key), "duplicate_keys"))
    else:
        totals = df.agg(*(c.alias(name) for name, c in row_metrics(rules).items()))

    def line(kind: str, column: str, violations: Column) -> Column:
        return F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(kind).alias("gate"),
            F.lit(column).alias("column"),
            violations.cast("bigint").alias("violations"),
            F.col("rows").alias("checked"),
            (violations == 0).alias("passed"),
        )

    lines = [line(ROW_COUNT, "", F.when(F.col("rows") == 0, 1).otherwise(0))]
    lines += [line(g.kind, g.column, F.col(g.metric)) for g in gates]
    return totals.select(F.inline(F.array(*lines)))


def duplicate_keys(df: DataFrame, key: Sequence[str], count: str = "copies") -> DataFrame:
    """Keys that more than one row has, with the number of rows."""
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)
    )


def _collect(report: DataFrame) -> list[GateResult]:
    """The report has one row per declared gate, so it fits the driver."""
    return [
        GateResult(r["dataset"], r["gate"], r["column"], r["violations"], r["checked"])
        for r in report.collect()
    ]


def _message(result: GateResult, rules: QualityRules) -> str:
    if result.gate == ROW_COUNT:
        return f"{result.dataset}: no rows"
    if result.gate == READABLE:
        what = f"values of {result.column}" if result.column else "records"
        return f"{result.dataset}: {result.violations} unreadable {what}"
    if result.gate == NO_DUPLICATES:
        # Fixed value: the run book looks for this text.
        return f"Duplicate records found using keys: {list(rules.key)}"
    if result.gate == VALUE_RANGE:
        bounds = rules.ranges[result.column]
        return (
            f"{result.dataset}: {result.violations} of {result.checked} values of "
            f"{result.column} lie outside [{bounds.min}, {bounds.max}]"
        )
    return f"{result.dataset}: {result.violations} rows lack {result.column}"


# The first failure in this order is the one reported.
_SEVERITY = (ROW_COUNT, READABLE, NOT_NULL, NO_DUPLICATES, VALUE_RANGE)


def enforce(
    report: DataFrame | Iterable[GateResult], rules: QualityRules
) -> list[GateResult]:
    """Raise ``QualityError`` for the first failed gate, else return all results."""
    results = _collect(report) if isinstance(report, DataFrame) else list(report)
    failed = [r for r in results if not r.passed]
    if failed:
        first = min(failed, key=lambda r: _SEVERITY.index(r.gate))
        raise QualityError(_message(first, rules), results)
    return results


def validate_row_count(df: DataFrame) -> int:
    """Number of rows; none at all is an error."""
    [result] = enforce(quality_report(df, QualityRules(), "dataset"), QualityRules())
    return result.checked


def _validate(df: DataFrame, rules: QualityRules) -> None:
    """Gates of the given rules on a dataset that may be empty."""
    results = _collect(quality_report(df, rules))
    enforce([r for r in results if r.gate != ROW_COUNT], rules)


def validate_not_null(df: DataFrame, required_columns: Sequence[str]) -> None:
    _validate(df, QualityRules(required=tuple(required_columns)))


def validate_no_duplicates(df: DataFrame, key_columns: Sequence[str]) -> None:
    _validate(df, QualityRules(key=tuple(key_columns)))


def validate_value_ranges(df: DataFrame, validation_rules: Mapping[str, Mapping]) -> None:
    ranges = {c: Range(b.get("min"), b.get("max")) for c, b in validation_rules.items()}
    _validate(df, QualityRules(ranges=ranges))


def layer_report(
    bronze: DataFrame, silver: DataFrame, gold: DataFrame, partition_column: str = "weather_date"
) -> DataFrame:
    """Gates across the layers: none is empty, every silver row has its partition value."""
    rules = QualityRules(partition_column=partition_column)
    return (
        quality_report(bronze, QualityRules(), "bronze")
        .unionByName(quality_report(silver, rules, "silver"))
        .unionByName(quality_report(gold, QualityRules(), "gold"))
    )


def run_data_quality_checks(
    bronze: DataFrame, silver: DataFrame, gold: DataFrame, partition_column: str = "weather_date"
) -> list[GateResult]:
    """Enforce ``layer_report``."""
    report = layer_report(bronze, silver, gold, partition_column)
    return enforce(report, QualityRules(partition_column=partition_column))
