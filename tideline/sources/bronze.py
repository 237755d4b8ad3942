"""The bronze layer: responses wrapped in an envelope, JSON by ingestion date."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import day_label, iso_utc, utc_wall_clock
from tideline.sources.sinks import exists, gather, observed, scratch_path, subfolders
from tideline.specs import FlattenSpec

INGESTION_DATE = "ingestion_date"
CORRUPT_RECORD = "_corrupt_record"


def raw_path(bronze_root: str, source: str, entity: str = "raw") -> str:
    return f"{bronze_root}/{source}/{entity}"


def bronze_schema(spec: FlattenSpec) -> T.StructType:
    """Schema of just the fields a flatten needs.

    Spark's JSON reader skips everything else, needs no inference pass, and a
    variable that no file has comes out as NULL. Elements are read as text, because one
    element of another type would make the reader drop its whole array; ``flatten`` casts
    them one by one.
    """
    names = dict.fromkeys([spec.axis, *spec.measures.values()])
    nested: T.DataType = T.StructType(
        [T.StructField(name, T.ArrayType(T.StringType())) for name in names]
    )
    head, *inner = spec.root.split(".")
    for name in reversed(inner):
        nested = T.StructType([T.StructField(name, nested)])
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in spec.carry]
        + [T.StructField(head, nested), T.StructField(CORRUPT_RECORD, T.StringType())]
    )


def propose_flatten(
    spark: SparkSession, path: str, root: str, axis: str = "time", documents: bool = False
) -> FlattenSpec:
    """A declaration for what the records below a folder hold; reads them all once.

    Every array of plain values beside the axis becomes a measure of its inferred type.
    A proposal to look at and keep: runs take a declaration and never infer.
    """
    found = spark.read.option("multiLine", documents).json(path).schema
    for name in root.split("."):
        if name not in found.names or not isinstance(found[name].dataType, T.StructType):
            raise ValueError(f"No record has the structure {root}")
        found = found[name].dataType
    arrays = {f.name: f.dataType.elementType for f in found if isinstance(f.dataType, T.ArrayType)}
    if axis not in arrays:
        raise ValueError(f"No array {axis} below {root}")
    measures = {
        name: kind
        for name, kind in arrays.items()
        if name != axis and not isinstance(kind, (T.StructType, T.ArrayType))
    }
    return FlattenSpec(root, {name: name for name in measures}, axis, types=measures)


def envelope(
    responses: DataFrame,
    source: str | Column,
    request_params: Mapping[str, object] | Column | None = None,
    ingested_at: Column | None = None,
    payload: str = "payload",
) -> DataFrame:
    """Wrap every response with ingestion time, source label and request parameters.

    ``payload`` may be nested columns or the response's text, which ``land`` keeps as it
    is. ``ingested_at`` is an instant, or a zone-less timestamp taken as UTC; the
    default is the start of the query.
    """
    ingested_at = F.current_timestamp() if ingested_at is None else ingested_at
    if isinstance(responses.select(ingested_at).schema[0].dataType, T.TimestampType):
        ingested_at = utc_wall_clock(ingested_at)
    body = F.col(payload)
    if isinstance(request_params, Mapping):
        request_params = F.struct(*(F.lit(v).alias(k) for k, v in request_params.items()))
    return responses.select(
        iso_utc(ingested_at).alias("ingestion_timestamp_utc"),
        (F.lit(source) if isinstance(source, str) else source).alias("source"),
        *([] if request_params is None else [request_params.alias("request_params")]),
        body.alias("payload"),
        day_label(ingested_at).alias(INGESTION_DATE),
    )


def _line(records: DataFrame, payload: str) -> Column:
    """A record as one line of JSON with the payload's own text inside.

    Line ends become spaces: JSON text has them only as white space. Text that is
    no JSON, or repeats a key, is kept as a JSON string, in which every character survives.
    """
    body = F.col(payload)
    readable = F.try_parse_json(body).isNotNull()
    kept = F.when(readable, F.translate(body, "\r\n", "  "))
    quoted = F.to_json(F.array(body))
    quoted = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    head = F.to_json(F.struct(*(c for c in records.columns if c not in (payload, INGESTION_DATE))))
    return F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1),
        F.lit(',"payload":'),
        F.coalesce(kept, quoted, F.lit("null")),
        F.lit("}"),
    )


def _lines(records: DataFrame, payload: str) -> DataFrame:
    """Records as lines of JSON, with their ingestion date."""
    if isinstance(records.schema[payload].dataType, T.StringType):
        line = _line(records, payload)
    else:
        line = F.to_json(F.struct(*(c for c in records.columns if c != INGESTION_DATE)))
    return records.select(line.alias("value"), INGESTION_DATE)


def land(
    records: DataFrame,
    path: str,
    compact: bool = False,
    payload: str = "payload",
    once: bool = False,
) -> None:
    """Append enveloped records as JSON lines, one directory per ingestion date.

    Nested payloads are written as JSON. Payloads that are text keep their bytes:
    numbers are not read and written again, fields keep their order, and a body that is no
    JSON lands as a string beside the others. One run normally brings one date, so
    the default is no shuffle: tasks write what they hold. ``compact`` first gathers
    the dates of a backfill. ``once`` leaves out records that their ingestion date has
    already, so that a landing may be repeated (see ``unlanded``).
    """
    if once:
        lines = unlanded(_lines(records, payload), path)
        (gather(lines, [INGESTION_DATE]) if compact else lines).write.mode("append").partitionBy(
            INGESTION_DATE
        ).text(path)
        return
    if compact:
        records = gather(records, [INGESTION_DATE])
    if isinstance(records.schema[payload].dataType, T.StringType):
        _lines(records, payload).write.mode("append").partitionBy(INGESTION_DATE).text(path)
    else:
        records.write.mode("append").partitionBy(INGESTION_DATE).json(path)


def unlanded(lines: DataFrame, path: str) -> DataFrame:
    """The lines that their ingestion date has not got yet, each once.

    Lines are told apart by the SHA-256 of their text, which is that of the record with its
    ingestion time, source, parameters and payload: two responses of one second both land,
    and one that comes back later with the same content lands again, because it may follow
    upon another. A retry must therefore bring the same records, with the same
    ``ingested_at``. The digests of a date are those of the lines that lie in its directory,
    so nothing else has to be kept, and only the dates of the lines are read. Two
    landings at the same time don't see each other.
    """
    spark, stored = lines.sparkSession, scratch_path(lines.sparkSession, "landing")
    seen, digest = Observation(), F.sha2("value", 256).alias("digest")
    bounds = {"low": F.min(INGESTION_DATE), "high": F.max(INGESTION_DATE)}
    observed(lines, seen, bounds).write.parquet(stored)
    new = spark.read.schema(lines.schema).parquet(stored).select("*", digest)
    new = new.dropDuplicates([INGESTION_DATE, "digest"])
    if subfolders(spark, path):
        there = (
            spark.read.schema(lines.schema)
            .text(path)
            .filter(F.col(INGESTION_DATE).between(F.lit(seen.get["low"]), F.lit(seen.get["high"])))
            .select(digest, INGESTION_DATE)
        )
        new = new.join(there, [INGESTION_DATE, "digest"], "left_anti")
    return new.select(*lines.columns)


def ingestion_dates(spark: SparkSession, path: str) -> list[str]:
    """The ingestion dates that have a directory; no file is opened."""
    prefix = f"{INGESTION_DATE}="
    return [n.removeprefix(prefix) for n in subfolders(spark, path) if n.startswith(prefix)]


def read_bronze(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    ingestion_date: str | Sequence[str] | None = None,
    documents: bool = False,
) -> DataFrame:
    """Bronze records, all of them or those of the given ingestion dates (``YYYY_MM_DD``).

    A date is read from its own directory, so the others are not even listed. A
    date without a directory gives no rows; a missing root is an error.
    ``documents`` reads files that hold one pretty-printed object (or array)
    each; such files cannot be split.
    """
    schema = T.StructType(schema.fields + [T.StructField(INGESTION_DATE, T.StringType())])
    reader = (
        spark.read.schema(schema)
        .option("basePath", path)
        .option("multiLine", documents)
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
    )
    if ingestion_date is None:
        return reader.json(path)
    dates = [ingestion_date] if isinstance(ingestion_date, str) else list(ingestion_date)
    for date in dates:
        if not re.fullmatch(r"\d{4}_\d{2}_\d{2}", date):
            raise ValueError(f"An ingestion date has the form YYYY_MM_DD: {date!r}")
    folders = [f"{path}/{INGESTION_DATE}={date}" for date in dict.fromkeys(dates)]
    there = [folder for folder in folders if exists(spark, folder)]
    if there:
        return reader.json(there)
    if not exists(spark, path):
        return reader.json(path)  # Spark's own error names the folder
    return spark.createDataFrame([], schema)


def record_metrics(spec: FlattenSpec) -> dict[str, Column]:
    """Counts of all records, unreadable ones, and readable ones without a single entry."""
    corrupt = F.col(CORRUPT_RECORD).isNotNull()
    entries = F.coalesce(F.size(f"{spec.root}.{spec.axis}"), F.lit(0))
    return {
        "records": F.count(F.lit(1)),
        "corrupt_records": F.count_if(corrupt),
        "empty_records": F.count_if(~corrupt & (entries <= 0)),
    }


def record_health(bronze: DataFrame, spec: FlattenSpec) -> DataFrame:
    """One row of ``record_metrics``."""
    return bronze.agg(*(c.alias(name) for name, c in record_metrics(spec).items()))
