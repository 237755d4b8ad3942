"""For every registered query the SQL that gives the same rows on the same tables."""

from __future__ import annotations

from workloads.events import SPAN

FLAT = f"""
WITH entries AS (
  SELECT event_type AS source, event_id // {SPAN} AS batch, event_id, value, ts,
         strftime(ts, '%Y-%m-%dT%H:00') AS weather_timestamp,
         strftime(ts, '%Y-%m-%d') AS weather_date
  FROM events),
batches AS (
  SELECT source, batch, count(*) AS entries, max(ts) AS received,
         min(event_id) AS first_event, max(event_id) AS last_event
  FROM entries GROUP BY source, batch),
records AS (
  SELECT *, strftime(received, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ingestion_timestamp_utc,
         strftime(received, '%Y_%m_%d') AS ingestion_date
  FROM batches),
flat AS (
  SELECT r.ingestion_timestamp_utc, e.source, e.batch, r.entries, e.weather_timestamp,
         e.event_id, e.value, 'dev' AS environment, e.weather_date,
         row_number() OVER (PARTITION BY e.source, e.batch ORDER BY e.event_id) - 1 AS idx
  FROM entries e JOIN records r ON e.source = r.source AND e.batch = r.batch)
"""

SILVER = (
    FLAT
    + """, ranked AS (
  SELECT *, count(*) OVER (PARTITION BY source, weather_timestamp) AS copies,
         row_number() OVER (PARTITION BY source, weather_timestamp
                            ORDER BY ingestion_timestamp_utc DESC, event_id DESC) AS place
  FROM flat),
silver AS (SELECT * FROM ranked WHERE place = 1)
"""
)

ROW = """ingestion_timestamp_utc, source, weather_timestamp, event_id, value,
  environment, weather_date"""


def _half_up(numerator: str, denominator: str) -> str:
    """numerator / denominator / 100 with the quotient rounded half away from zero."""
    return (
        f"CAST(sign({numerator}) * ((2 * abs({numerator}) + {denominator}) "
        f"// (2 * {denominator})) AS DOUBLE) / 100"
    )


def _ticks(column: str) -> str:
    return f"sum(CAST(round({column} * 10000) AS HUGEINT))"


def avg2(column: str) -> str:
    return _half_up(_ticks(column), f"(100 * count({column}))")


def sum2(column: str) -> str:
    return _half_up(_ticks(column), "100")


def max2(column: str) -> str:
    return _half_up(f"CAST(round(max({column}) * 10000) AS HUGEINT)", "100")


GOLD = (
    SILVER
    + f""", gold AS (
  SELECT environment, source, weather_date, {avg2('value')} AS avg_value,
         {sum2('value')} AS total_value, {max2('value')} AS max_value,
         max(event_id) AS last_event
  FROM silver GROUP BY environment, source, weather_date)
"""
)


#: The weather feed's newest readings; ``hottest`` are those whose temperature is the value.
WEATHER = (
    FLAT
    + """, readings AS (
  SELECT f.*, round(f.value / 10, 3) AS temperature_2m, f.value AS hot,
         CAST(v.user_id % 101 AS DOUBLE) AS relative_humidity_2m
  FROM flat f JOIN events v ON v.event_id = f.event_id),
newest AS (
  SELECT * FROM readings QUALIFY row_number() OVER (
    PARTITION BY source, weather_timestamp
    ORDER BY ingestion_timestamp_utc DESC, temperature_2m DESC,
             relative_humidity_2m DESC, value DESC) = 1),
hottest AS (
  SELECT * FROM readings QUALIFY row_number() OVER (
    PARTITION BY source, weather_timestamp
    ORDER BY ingestion_timestamp_utc DESC, hot DESC, relative_humidity_2m DESC) = 1)
"""
)


def _gate(dataset: str, gate: str, column: str, violations: str, checked: str = "count(*)") -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{gate}' AS gate, '{column}' AS \"column\", "
        f"CAST({violations} AS BIGINT) AS violations, CAST({checked} AS BIGINT) AS checked, "
        f"({violations}) = 0 AS passed"
    )


def _row_count(dataset: str, table: str) -> str:
    empty = "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"
    return f"{_gate(dataset, 'row_count', '', empty)} FROM {table}"


def _violations(dataset: str, gate: str, column: str, condition: str, table: str) -> str:
    return f"{_gate(dataset, gate, column, f'count(*) FILTER (WHERE {condition})')} FROM {table}"


def _dq_not_null() -> str:
    checks = {
        "source": "event_type = 'error'",
        "user_id": "user_id IS NULL",
        "value": "event_type = 'click' OR value IS NULL",
        "weather_date": "event_type = 'view' OR ts IS NULL",
    }
    return " UNION ALL ".join(
        _violations("silver", "not_null", column, condition, "events")
        for column, condition in checks.items()
    )


def _dq_value_ranges() -> str:
    checks = {
        "l_quantity": "l_quantity < 1 OR l_quantity > 49",
        "l_discount": "l_discount > 0.05",
        "l_tax": "l_tax < 0.02",
        "l_extendedprice": "FALSE",
    }
    return " UNION ALL ".join(
        _violations("lineitem", "value_range", column, condition, "lineitem")
        for column, condition in checks.items()
    )


def _dq_report() -> str:
    key = "source, weather_timestamp, environment"
    duplicates = f"(SELECT count(*) FROM (SELECT 1 FROM flat GROUP BY {key} HAVING count(*) > 1))"
    parts = [
        _row_count("flattened", "flat"),
        _violations(
            "flattened", "not_null", "weather_timestamp", "weather_timestamp IS NULL", "flat"
        ),
        _violations("flattened", "not_null", "value", "value IS NULL", "flat"),
        _violations("flattened", "value_range", "value", "value < 0 OR value > 300", "flat"),
        _gate("flattened", "no_duplicates", key, duplicates, "(SELECT count(*) FROM flat)"),
    ]
    return FLAT + " UNION ALL ".join(parts)


def _dq_layers() -> str:
    parts = [
        _row_count("bronze", "records"),
        _row_count("silver", "silver"),
        _violations("silver", "not_null", "weather_date", "weather_date IS NULL", "silver"),
        _row_count("gold", "gold"),
    ]
    return GOLD + " UNION ALL ".join(parts)


def _dq_row_count() -> str:
    tables = {
        "empty": "(SELECT * FROM events WHERE event_type = 'absent')",
        "events": "events",
        "orders": "orders",
        "lineitem": "lineitem",
    }
    union = " UNION ALL ".join(_row_count(name, table) for name, table in tables.items())
    return f"SELECT dataset, violations, checked, passed FROM ({union})"


RUNS = """
WITH runs AS (
  SELECT 'dev' AS environment, event_type AS pipeline_name,
         strftime(min(ts), '%Y-%m-%dT%H:%M:%S.%f+00:00') AS start_time,
         strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f+00:00') AS end_time,
         count(*) AS bronze_row_count,
         count(DISTINCT strftime(ts, '%Y-%m-%dT%H')) AS silver_row_count,
         CAST(CASE WHEN max(value) > 300 THEN 0 ELSE 1 END AS BIGINT) AS gold_row_count,
         CASE WHEN max(value) > 300 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         CASE WHEN max(value) > 300
              THEN 'Column value has ' || count(*) FILTER (WHERE value > 300)
                   || ' values outside range 0 to 300'
              ELSE '' END AS error_message
  FROM events GROUP BY event_type, CAST(ts AS DATE))
"""

ALL_SILVER = f"{SILVER} SELECT {ROW} FROM silver"
ALL_GOLD = f"{GOLD} SELECT * FROM gold"

ORACLES: dict[str, str] = {
    "bronze_land_envelope": f"""{FLAT}
        SELECT source, ingestion_timestamp_utc, ingestion_date, entries, first_event, last_event
        FROM records""",
    "bronze_land_repeated": f"""{FLAT}
        SELECT source, ingestion_timestamp_utc, ingestion_date, entries, first_event FROM records""",
    "bronze_scan_all": f"""{FLAT}
        SELECT ingestion_date, count(*) AS records, CAST(sum(entries) AS BIGINT) AS entries
        FROM records GROUP BY ingestion_date""",
    "bronze_scan_partition": f"""{FLAT}
        SELECT source, ingestion_timestamp_utc, ingestion_date
        FROM records WHERE ingestion_date = '2024_01_15'""",
    "bronze_record_health": f"""{FLAT}
        SELECT count(*) AS records,
               count(*) FILTER (WHERE source = 'error') AS corrupt_records,
               count(*) FILTER (WHERE source = 'view') AS empty_records
        FROM records""",
    "nested_project": f"""{FLAT}
        SELECT source, ingestion_timestamp_utc, entries,
               max(CASE WHEN idx = 0 THEN weather_timestamp END) AS first_hour,
               max(CASE WHEN idx = 0 THEN value END) AS first_value,
               max(CASE WHEN idx = entries - 1 THEN value END) AS last_value
        FROM flat GROUP BY source, ingestion_timestamp_utc, entries, batch""",
    "flatten_hourly": f"""{FLAT}
        SELECT ingestion_timestamp_utc, source, idx, weather_timestamp, event_id, value
        FROM flat""",
    "flatten_ragged": f"""{FLAT}
        SELECT ingestion_timestamp_utc, source, weather_timestamp, event_id,
               CASE WHEN source = 'error' AND idx = entries - 1 THEN NULL ELSE value END AS value
        FROM flat""",
    "silver_conform": f"{FLAT} SELECT {ROW} FROM flat",
    "dedupe_latest": f"{SILVER} SELECT {ROW}, copies FROM silver",
    "dedupe_keys": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "dq_row_count": _dq_row_count(),
    "dq_not_null": _dq_not_null(),
    "dq_duplicates": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_value_ranges": _dq_value_ranges(),
    "dq_report": _dq_report(),
    "dq_layers": _dq_layers(),
    "gold_daily": ALL_GOLD,
    "gold_wide_values": f"""{SILVER}
        SELECT environment, source, weather_date,
               CAST(sum(wide) AS DOUBLE) AS total_wide, CAST(max(wide) AS DOUBLE) AS max_wide
        FROM (SELECT *, CAST(round(value * 100) AS HUGEINT) << CAST(event_id % 24 AS INTEGER) AS wide
              FROM silver)
        GROUP BY environment, source, weather_date""",
    "gold_daily_lineitem": f"""
        SELECT strftime(l_shipdate, '%Y-%m-%d') AS ship_date,
               {avg2('l_extendedprice')} AS avg_price,
               {sum2('l_extendedprice')} AS total_price,
               {max2('l_extendedprice')} AS max_price,
               {avg2('l_quantity')} AS avg_quantity,
               {sum2('l_quantity')} AS total_quantity,
               {avg2('l_discount')} AS avg_discount,
               CAST(sum(l_linenumber) AS BIGINT) AS total_lines
        FROM lineitem GROUP BY 1""",
    "gold_daily_orders": f"""
        SELECT o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
               {avg2('o_totalprice')} AS avg_price,
               {sum2('o_totalprice')} AS total_price,
               {max2('o_totalprice')} AS max_price
        FROM orders GROUP BY 1, 2""",
    "silver_write_readback": ALL_SILVER,
    "gold_write_readback": ALL_GOLD,
    "overwrite_static": f"{ALL_SILVER} WHERE weather_date >= '2024-01-16'",
    "overwrite_dynamic": ALL_SILVER,
    "upsert_incremental": ALL_SILVER,
    "upsert_buckets": ALL_SILVER,
    "upsert_moving_keys": """
        SELECT event_type AS source, event_id % 499 AS sensor, event_id, value,
               strftime(ts, '%Y-%m-%d') AS weather_date
        FROM events QUALIFY row_number() OVER (
          PARTITION BY event_type, event_id % 499 ORDER BY event_id DESC) = 1""",
    "keys_moved": """
        SELECT event_type AS source, event_id % 499 AS sensor,
               count(DISTINCT CAST(ts AS DATE)) AS partitions
        FROM events GROUP BY 1, 2 HAVING count(DISTINCT CAST(ts AS DATE)) > 1""",
    "verified_readback": f"""{SILVER}
        SELECT count(*) AS rows, TRUE AS lost_noticed, TRUE AS doubled_noticed FROM silver""",
    "serving_overwrite": ALL_GOLD,
    "serving_select_gold": f"""{GOLD}, first_slice AS (
          SELECT max(ingestion_date) AS d FROM records), static_gold AS (
          SELECT 'static' AS mode, environment, source, weather_date, {avg2('value')} AS avg_value,
                 {sum2('value')} AS total_value, {max2('value')} AS max_value,
                 max(event_id) AS last_event
          FROM (SELECT f.*, row_number() OVER (
                  PARTITION BY source, weather_timestamp
                  ORDER BY f.ingestion_timestamp_utc DESC, f.event_id DESC) AS place
                FROM flat f JOIN records r USING (source, batch)
                WHERE r.ingestion_date = (SELECT d FROM first_slice))
          WHERE place = 1 GROUP BY environment, source, weather_date)
        SELECT * FROM static_gold UNION ALL SELECT 'upsert', * FROM gold""",
    "audit_append": f"{RUNS} SELECT * FROM runs",
    "audit_compacted": f"{RUNS} SELECT * FROM runs",
    "audit_history": f"{RUNS} SELECT * EXCLUDE (error_message) FROM runs ORDER BY start_time DESC",
    "audit_failures": f"""{RUNS}
        SELECT start_time, status, error_message FROM runs
        WHERE status = 'FAILED' ORDER BY start_time DESC""",
    "audit_latest_status": f"""{RUNS}
        SELECT environment, pipeline_name, max(start_time) AS start_time,
               arg_max(status, start_time) AS status
        FROM runs GROUP BY environment, pipeline_name""",
    "sample_top_n": """
        SELECT event_id, event_type, value FROM events
        ORDER BY value DESC, event_id LIMIT 10""",
    "weather_full_run": f"""{WEATHER}
        SELECT 'prod' AS environment, source, weather_date,
               {avg2('temperature_2m')} AS avg_temperature,
               {max2('temperature_2m')} AS max_temperature,
               {avg2('relative_humidity_2m')} AS avg_humidity,
               {sum2('value')} AS total_precipitation,
               {max2('value')} AS max_wind_speed
        FROM newest GROUP BY source, weather_date""",
    "weather_failed_run": f"""{WEATHER}
        SELECT 'prod' AS environment, 'FAILED' AS status,
               (SELECT count(*) FROM records) AS bronze_row_count,
               CAST(0 AS BIGINT) AS silver_row_count, CAST(0 AS BIGINT) AS gold_row_count,
               'silver: ' || count(*) FILTER (WHERE hot > 60) || ' of ' || count(*)
                 || ' values of temperature_2m lie outside [-50, 60]' AS reason,
               FALSE AS published
        FROM hottest""",
    "gold_daily_fine": f"""{SILVER}
        SELECT environment, source, weather_date,
               CAST(sign(t) * ((2 * abs(t) + n * 10000000) // (2 * n * 10000000)) AS DOUBLE) / 100
                 AS avg_fine,
               CAST(sign(t) * ((2 * abs(t) + 10000000) // 20000000) AS DOUBLE) / 100 AS total_fine,
               CAST((2 * e * 100 + n) // (2 * n) AS DOUBLE) / 100 AS avg_event
        FROM (SELECT environment, source, weather_date, count(*) AS n,
                     sum(CAST(round((value + event_id / 1000000.0::DOUBLE) * 1000000000::DOUBLE)
                         AS HUGEINT)) AS t,
                     sum(CAST(event_id AS HUGEINT)) AS e
              FROM silver GROUP BY environment, source, weather_date)""",
    "bronze_unreadable_values": f"""{FLAT}
        SELECT source, ingestion_timestamp_utc, idx, weather_timestamp, event_id,
               CASE WHEN event_id % 7 = 3 THEN NULL ELSE value END AS value,
               CAST(CASE WHEN event_id % 7 = 3 THEN 1 ELSE 0 END AS BIGINT) AS unreadable
        FROM flat""",
    "bronze_land_text": """
        SELECT event_id, event_type AS source,
               CASE WHEN event_id % 5 = 0 THEN '{"hourly": [16.0, ' || event_id
                    WHEN event_id % 5 = 1 THEN ''
                    WHEN event_id % 5 = 2 THEN '{"a": 1, "a": ' || event_id || '}'
                    ELSE '{"z": 16.0, "long": 12345678901234567890123456789012345678901234567890,'
                         || ' "e": "\\u00e9\\n", "id": ' || event_id || '}' END AS payload,
               event_id % 5 >= 3 AS nested
        FROM events""",
    "medallion_full_run": ALL_GOLD,
    "medallion_intake": ALL_GOLD,
    "medallion_resumed": ALL_GOLD,
    "medallion_tolerant": f"""{FLAT}, good AS (
          SELECT * FROM flat WHERE value BETWEEN 0 AND 300
          QUALIFY row_number() OVER (
            PARTITION BY source, weather_timestamp
            ORDER BY ingestion_timestamp_utc DESC, event_id DESC) = 1)
        SELECT environment, source, weather_date, {avg2('value')} AS avg_value,
               {sum2('value')} AS total_value, {max2('value')} AS max_value,
               max(event_id) AS last_event
        FROM good GROUP BY environment, source, weather_date""",
    "quarantine_reasons": """
        SELECT 'row' AS kind, event_type AS source, 'value_range:value' AS reason,
               count(*) AS rows
        FROM events WHERE value < 0 OR value > 300 GROUP BY event_type""",
    "routed_rows": """
        SELECT event_id, value, concat_ws(' ',
                 CASE WHEN event_id IS NULL THEN 'not_null:event_id' END,
                 CASE WHEN value < 10 OR value > 300 THEN 'value_range:value' END,
                 CASE WHEN event_id < 5 THEN 'value_range:event_id' END) AS reasons
        FROM events""",
    "medallion_incremental_runs": ALL_GOLD,
    "medallion_run_log": f"""{GOLD}, counts AS (
          SELECT (SELECT count(*) FROM records) AS bronze_row_count,
                 (SELECT count(*) FROM silver) AS silver_row_count,
                 (SELECT count(*) FROM gold) AS gold_row_count,
                 (SELECT count(*) FROM silver WHERE value < 0 OR value > 300) AS high)
        SELECT 'dev' AS environment, 'weather_pipeline' AS pipeline_name, bronze_row_count,
               silver_row_count, gold_row_count, 'SUCCESS' AS status, '' AS reason
        FROM counts
        UNION ALL
        SELECT 'dev', 'strict', bronze_row_count,
               CAST(CASE WHEN high > 0 THEN 0 ELSE silver_row_count END AS BIGINT),
               CAST(CASE WHEN high > 0 THEN 0 ELSE gold_row_count END AS BIGINT),
               CASE WHEN high > 0 THEN 'FAILED' ELSE 'SUCCESS' END,
               CASE WHEN high > 0
                    THEN 'silver: ' || high || ' of ' || silver_row_count
                         || ' values of value lie outside [0, 300]'
                    ELSE '' END
        FROM counts""",
}
