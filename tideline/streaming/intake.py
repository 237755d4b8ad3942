"""Every landed file once: the bronze folder as a stream, its checkpoint as the memory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tideline.plans.journal import Journal
from tideline.plans.run import RunResult, RunSpec, run_records
from tideline.sources.bronze import CORRUPT_RECORD, INGESTION_DATE, bronze_schema


def intake(
    spark: SparkSession,
    spec: RunSpec,
    checkpoint: str,
    max_files: int | None = None,
    max_file_age: str = "3650d",
) -> list[RunResult]:
    """Run over all files that landed since the last call, and return a result a batch.

    ``checkpoint`` is a folder on shared storage that belongs to one spec. Spark keeps there
    which files each batch has, before the batch is worked on, and the batch's finished
    steps lie beside it. A batch that was interrupted is done again with the same files,
    from its last finished step: rows are merged by key and version, so that silver, gold and
    serving end as if it had run once, and it is set aside and logged once.

    ``max_files`` bounds a batch. Files are told apart by name and must not change. Those whose
    modification time lies more than ``max_file_age`` before that of the newest are not seen.
    A batch without any entry is passed over. A batch that fails a gate ends the call
    with that error and is tried again by the next.
    """
    schema = bronze_schema(spec.flatten)
    schema = T.StructType(schema.fields + [T.StructField(INGESTION_DATE, T.StringType())])
    reader = (
        spark.readStream.schema(schema)
        .option("multiLine", spec.documents)
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        .option("maxFileAge", max_file_age)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    results: list[RunResult] = []
    failures: list[Exception] = []

    def work(batch: DataFrame, number: int) -> None:
        # Only the first step reads the batch; what it stores is merged in the caller's session,
        # because Spark turns adaptive execution off in that of a stream.
        journal = Journal.of_run(spark, f"{checkpoint.rstrip('/')}/journal", f"batch-{number}")
        try:
            results.append(run_records(spark, spec, lambda: batch, journal, nothing_ok=True))
        except Exception as error:
            failures.append(error)
            raise

    query = (
        reader.json(spec.bronze_path)
        .writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except Exception:
        if failures:
            raise failures[0] from None
        raise
    return results
