"""Times the headline queries and, beside them, the plain way of doing the same work.

Prints one JSON line. ``queries`` holds warm medians in seconds; ``plain`` holds
the same results reached with the operators a first draft would use: arbitrary
de-duplication, one job per gate, one writing task, a rebuild instead of an upsert.
"""

from __future__ import annotations

import contextlib
import json
import os
import statistics
import sys
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.operators.aggregate import aggregate
from tideline.operators.dedupe import dedupe_latest
from tideline.operators.quality import out_of_range, quality_report
from tideline.plans.incremental import upsert
from tideline.session import session
from tideline.sources.sinks import scratch_path, write_partitioned
from workloads import events as ev
from workloads.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_RUNS = int(os.environ.get("BENCH_RUNS", "3"))
#: How often the events are repeated, under other sources, for the comparisons.
COPIES = int(os.environ.get("BENCH_COPIES", "40"))

HEADLINES = [
    "flatten_hourly",
    "dedupe_latest",
    "dedupe_keys",
    "dq_report",
    "dq_duplicates",
    "dq_value_ranges",
    "gold_daily",
    "gold_daily_fine",
    "gold_daily_lineitem",
    "gold_daily_orders",
    "silver_write_readback",
    "upsert_incremental",
    "audit_history",
    "medallion_full_run",
    "medallion_incremental_runs",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    work()
    seconds = []
    for _ in range(WARM_RUNS):
        start = time.perf_counter()
        work()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def jobs_of(spark: SparkSession, work) -> int:
    """How many Spark jobs the work starts."""
    context, group = spark.sparkContext, f"bench-{uuid.uuid4().hex}"
    context.setJobGroup(group, group)
    work()
    found = len(context.statusTracker().getJobIdsForGroup(group))
    context.setJobGroup("bench", "bench")
    return found


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def comparisons(spark: SparkSession) -> dict[str, dict[str, float]]:
    """The library's way and the plain way on the same stored rows, some millions of them."""
    copies = F.explode(F.sequence(F.lit(1), F.lit(COPIES))).alias("copy")
    flat = stored(
        spark,
        ev.flat(spark, SF_DIR)
        .select("*", copies)
        .withColumn("source", F.concat_ws("-", "source", "copy"))
        .drop("copy"),
        "flat",
    )
    silver = stored(spark, dedupe_latest(flat, ev.KEY, ["ingestion_timestamp_utc"]), "silver")
    plain_gold = [
        F.round(getattr(F, m.aggregation)(m.source_column), 2).alias(name)
        for name, m in ev.GOLD.measures.items()
    ]
    newest = Window.partitionBy(*ev.KEY).orderBy(F.desc("ingestion_timestamp_utc"))

    def gates_one_by_one() -> None:
        for name in ev.RULES.required:
            silver.filter(F.col(name).isNull()).count()
        silver.groupBy(*ev.KEY).count().filter("count > 1").count()
        for name, bounds in ev.RULES.ranges.items():
            silver.filter(out_of_range(name, bounds)).count()
        silver.filter(F.col("weather_date").isNull()).count()
        silver.count()

    paths: dict[str, str] = {}

    def here_write() -> None:
        paths["here"] = scratch_path(spark, "w")
        write_partitioned(silver, paths["here"], ["weather_date"])

    def one_task_write() -> None:
        paths["plain"] = scratch_path(spark, "plain")
        silver.repartition(1).write.partitionBy("weather_date").parquet(paths["plain"])

    lake = scratch_path(spark, "lake")
    upsert(spark, flat, lake, ev.KEY, ["ingestion_timestamp_utc"], "weather_date")
    last_day = flat.filter(F.col("weather_date") == flat.agg(F.max("weather_date")).first()[0])

    def one_day() -> None:
        upsert(spark, last_day, lake, ev.KEY, ["ingestion_timestamp_utc"], "weather_date")

    def rebuild() -> None:
        upsert(
            spark, flat, scratch_path(spark, "lake"), ev.KEY, ["ingestion_timestamp_utc"],
            "weather_date",
        )

    pairs = {
        "dedupe_vs_row_number": (
            lambda: drain(dedupe_latest(flat, ev.KEY, ["ingestion_timestamp_utc"])),
            lambda: drain(flat.withColumn("n", F.row_number().over(newest)).filter("n = 1")),
        ),
        "dedupe_vs_arbitrary": (
            lambda: drain(dedupe_latest(flat, ev.KEY, ["ingestion_timestamp_utc"])),
            lambda: drain(flat.dropDuplicates(list(ev.KEY))),
        ),
        "gold": (
            lambda: drain(aggregate(flat, ev.GOLD)),
            lambda: drain(flat.groupBy(*ev.GOLD.keys).agg(*plain_gold)),
        ),
        "gates": (lambda: quality_report(silver, ev.RULES).collect(), gates_one_by_one),
        "write": (here_write, one_task_write),
        "one_day": (one_day, rebuild),
    }
    found: dict[str, dict[str, float]] = {}
    for name, (ours, plain) in pairs.items():
        found[name] = {
            "here": timed(ours),
            "plain": timed(plain),
            "jobs_here": jobs_of(spark, ours),
            "jobs_plain": jobs_of(spark, plain),
        }
    for way, path in paths.items():
        found["write"][f"files_{way}"] = len(spark.read.parquet(path).inputFiles())
    found["rows"] = {"flat": flat.count(), "silver": silver.count()}
    return found


def main() -> None:
    settings = {
        "spark.master": f"local[{CPUS}]",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    }
    # Spark writes start-up notes to the terminal; only the JSON line is wanted there.
    with contextlib.redirect_stdout(sys.stderr):
        spark = session("bench", settings)
        spark.sparkContext.setLogLevel("ERROR")
        seconds = {
            name: timed(lambda query=QUERIES[name]: drain(query(spark, SF_DIR)))
            for name in HEADLINES
        }
        plain = comparisons(spark)
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "plain": plain,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
