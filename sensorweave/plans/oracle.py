"""The same queries as plain SQL, for checking against another engine.

Each starts from the same ``events`` table; computed doubles are rounded like
the Spark results.
"""

from __future__ import annotations

READINGS = """
SELECT time, sensor_id, temperature, humidity,
       CASE WHEN event_id % 101 = 0 THEN NULL ELSE ep - (d1 + d2 + d3) / 1000e0 END AS mqtt_receive_time,
       ep - (d2 + d3) / 1000e0 AS kafka_send_time,
       ep - d3 / 1000e0 AS spark_receive_time,
       event_id, d1, d2, d3, ep, event_id // 10 AS batch
FROM (SELECT make_timestamp(1704067200000000 + (event_id * 500 + k) * 1000) AS time,
             (1704067200000000 + (event_id * 500 + k) * 1000) / 1e6 AS ep,
             concat('sensor-', cast(user_id % 5 + 1 AS varchar)) AS sensor_id,
             CASE WHEN event_id % 211 = 0 THEN NULL ELSE 15e0 + value / 5e0 END AS temperature,
             CASE WHEN event_id % 223 = 0 THEN NULL ELSE 30e0 + k * 0.75e0 END AS humidity,
             user_id % 40 + 1 AS d1, k % 200 + 5 AS d2, event_id % 1100 + 10 AS d3, event_id
      FROM (SELECT *, cast(props::json->>'k' AS bigint) AS k FROM events))
"""

LATENCY = """
SELECT time, sensor_id, temperature, humidity, spark_receive_time, mqtt_receive_time, kafka_send_time,
       (kafka_send_time - mqtt_receive_time) * 1000 AS mqtt_to_kafka_ms,
       (spark_receive_time - kafka_send_time) * 1000 AS kafka_to_spark_ms,
       (epoch_us(time) / 1e6 - spark_receive_time) * 1000 AS spark_to_db_ms,
       (epoch_us(time) / 1e6 - mqtt_receive_time) * 1000 AS total_latency_ms
FROM sensor_data WHERE mqtt_receive_time IS NOT NULL
"""

BATCHES = """
SELECT batch, max(time) AS time, cast(count(*) AS integer) AS message_count,
       avg(d1) AS v1, avg(d2) AS v2, avg(d3) AS v3, avg(d3) / 1000 AS processing_time
FROM sensor_data GROUP BY batch
"""

KPI = """
SELECT time, metric_name, value_ms, cast(batch AS varchar) AS batch_id, message_count
FROM (SELECT time, batch, message_count, 'mqtt_to_kafka' AS metric_name, v1 AS value_ms FROM batches
      UNION ALL SELECT time, batch, message_count, 'kafka_to_spark', v2 FROM batches
      UNION ALL SELECT time, batch, message_count, 'spark_to_timescaledb', v3 FROM batches
      UNION ALL SELECT time, batch, message_count, 'total_pipeline_latency', v1 + v2 + v3 FROM batches)
"""

METRICS = """
SELECT time, cast(batch AS varchar) AS batch_id, processing_time,
       avg(processing_time) OVER w AS avg_processing_time,
       min(processing_time) OVER w AS min_processing_time,
       max(processing_time) OVER w AS max_processing_time,
       coalesce(stddev_samp(processing_time) OVER w, 0) AS stddev_processing_time,
       cast(count(processing_time) OVER w AS integer) AS sample_size,
       median(processing_time) OVER w AS median_processing_time
FROM batches WINDOW w AS (ORDER BY batch ROWS BETWEEN 499 PRECEDING AND CURRENT ROW)
"""

# Messages as text; malformed ones are found by validity, not by number.
PLAIN = """
SELECT event_id AS kafka_offset, make_timestamp(1704067200000000 + (event_id * 500 + k) * 1000) AS arrival,
       CASE WHEN event_id % 97 = 0 THEN 'not json'
            ELSE cast(json_object('temperature', 15e0 + value / 5e0, 'humidity', 30e0 + k * 0.75e0,
                                  'timestamp', (1704067200000000 + (event_id * 500 + k) * 1000) / 1e6) AS varchar)
       END AS message
FROM (SELECT *, cast(props::json->>'k' AS bigint) AS k FROM events)
"""

BRIDGED = """
SELECT r.event_id AS kafka_offset, time, sensor_id, temperature, humidity, mqtt_receive_time, kafka_send_time, ep,
       CASE WHEN r.event_id % 97 = 0 THEN 'not json' ELSE '{}' END AS message
FROM sensor_data r
"""

# The same readings half a minute apart: days instead of hours.
LONG = READINGS.replace("event_id * 500", "event_id * 30000")
LONG_LATENCY = LATENCY.replace("FROM sensor_data", "FROM long_series")
LONG_RANGE = (
    "time >= '2024-01-01 03:17:23.456'::timestamp AND "
    "time <= (SELECT max(time) FROM long_series) - INTERVAL '1 hour' - INTERVAL '7500 milliseconds'"
)

# Messages of the long series in three batches: first half, second half, late ones.
BATCHED = """
SELECT event_id AS kafka_offset, time, sensor_id, temperature, humidity, mqtt_receive_time, kafka_send_time,
       CASE WHEN event_id % 97 = 0 THEN 'not json' ELSE '{}' END AS message,
       CASE WHEN event_id % 50 = 7 THEN 2 WHEN event_id * 2 <= (SELECT max(event_id) FROM long_series) THEN 0 ELSE 1 END AS part
FROM long_series WHERE (event_id // 4) % 7 <> 3
"""
WATERMARKS = """
SELECT part, count(*) AS n, max(max(time)) OVER (ORDER BY part) AS newest,
       max(max(time)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
FROM good_batched GROUP BY part
"""

# Minutes are judged before the late messages come; two bad ones in a row fire the first rule.
ALERTS = """,
counted AS (SELECT 'throughput' AS rule, time_bucket(INTERVAL '1 minute', time) AS minute, count(*) AS value FROM batched
            WHERE part < 2 AND json_valid(message) GROUP BY 2
            UNION ALL SELECT 'errors', time_bucket(INTERVAL '1 minute', time), count(*) FROM batched
            WHERE part < 2 AND NOT json_valid(message) GROUP BY 2),
spine AS (SELECT rule, hold, unnest(generate_series((SELECT min(minute) FROM counted),
            (SELECT time_bucket(INTERVAL '1 minute', max(newest) - INTERVAL '10 minutes') FROM watermarks) - INTERVAL '1 minute',
            INTERVAL '1 minute')) AS minute
          FROM (VALUES ('throughput', 2), ('errors', 1)) AS r(rule, hold)),
judged AS (SELECT rule, hold, minute, coalesce(value, 0) AS value,
                  CASE WHEN rule = 'errors' THEN coalesce(value, 0) >= 1 ELSE coalesce(value, 0) < 2 END AS bad
           FROM spine LEFT JOIN counted USING (rule, minute)),
runs AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY rule ORDER BY minute) AS run FROM judged),
places AS (SELECT *, sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY rule, run ORDER BY minute) AS place FROM runs),
before AS (SELECT *, coalesce(lag(CASE WHEN bad THEN place ELSE 0 END) OVER (PARTITION BY rule ORDER BY minute), 0) AS was FROM places),
told AS (SELECT rule, minute, value,
                CASE WHEN bad AND place = hold THEN 'firing' WHEN bad AND place = 1 THEN 'pending'
                     WHEN NOT bad AND was >= hold THEN 'resolved' WHEN NOT bad AND was > 0 THEN 'inactive' END AS state
         FROM before)
SELECT rule, minute, state, value FROM told WHERE state IS NOT NULL"""

NEWEST = "SELECT max(time) AS now FROM sensor_data"
MIDDLE = "SELECT time AS now FROM sensor_data WHERE event_id = (SELECT max(event_id) // 2 FROM sensor_data)"
IN_THE_MIDDLE = {
    "recent_count_asof": "recent_count",
    "hourly_summary_asof": "hourly_sensor_summary",
    "latest_readings_asof": "latest_readings",
    "latency_stats_kpi_asof": "latency_stats_kpi",
}

TABLES = {
    "sensor_data": ((), READINGS),
    "pipeline_latency": (("sensor_data",), LATENCY),
    "batches": (("sensor_data",), BATCHES),
    "pipeline_kpi": (("batches",), KPI),
    "processing_metrics": (("batches",), METRICS),
    "plain": ((), PLAIN),
    "good": (("plain",), "SELECT * FROM plain WHERE json_valid(message)"),
    "bridged": (("sensor_data",), BRIDGED),
    "streamed": (("bridged",), "SELECT * FROM bridged WHERE json_valid(message)"),
    "as_of": (("sensor_data",), NEWEST),
    "gaps": (
        ("sensor_data",),
        "SELECT * FROM sensor_data WHERE (event_id // 120) % 7 <> 3 AND NOT ((event_id // 120) % 5 = 1 AND event_id % 2 = 1)",
    ),
    "long_series": ((), LONG),
    "batched": (("long_series",), BATCHED),
    "good_batched": (("batched",), "SELECT * FROM batched WHERE json_valid(message)"),
    "watermarks": (("good_batched",), WATERMARKS),
    "late": (
        ("good_batched", "watermarks"),
        "SELECT m.* FROM good_batched m JOIN watermarks w USING (part) WHERE m.time < w.before - INTERVAL '10 minutes'",
    ),
    "long_batches": (("long_series",), BATCHES.replace("FROM sensor_data", "FROM long_series")),
    "long_kpi": (("long_batches",), KPI.replace("FROM batches", "FROM long_batches")),
    "sparse_series": ((), READINGS.replace("event_id * 500", "event_id * 120000")),
    "long_latency": (("long_series",), LONG_LATENCY),
}

ALWAYS = "'2024-01-01'::timestamp AND '2100-01-01'::timestamp"
STAGES = (
    "(VALUES (1, 'mqtt_to_kafka', 'MQTT → Kafka'), (2, 'kafka_to_spark', 'Kafka → Spark'), "
    "(3, 'spark_to_timescaledb', 'Spark → TimescaleDB'), (4, 'total_pipeline_latency', 'Total (bout en bout)')) "
    "AS s(n, metric_name, stage)"
)


def r(expression: str, name: str | None = None, places: int = 6) -> str:
    """A rounded double column."""
    return f"round({expression}, {places}) + 0e0 AS {name or expression}"


def rs(*names: str, places: int = 6) -> str:
    return ", ".join(r(name, places=places) for name in names)


def recent(window: str) -> str:
    return f"time > (SELECT now FROM as_of) - INTERVAL '{window}' AND time <= (SELECT now FROM as_of)"


def bucket(width: str, column: str = "time") -> str:
    return f"time_bucket(INTERVAL '{width}', {column})"


def with_tables(query: str, *names: str) -> str:
    """Prefixes the query with the definitions of the tables it names."""
    needed: list[str] = []

    def add(name: str) -> None:
        for parent in TABLES[name][0]:
            add(parent)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n][1]})" for n in needed) + "\n" + query


def _sensor(query: str) -> str:
    names = ["sensor_data"] + (["as_of"] if "as_of" in query else [])
    return with_tables(query, *names)


def _long(query: str) -> str:
    return with_tables(query, "long_series")


def _latency(query: str) -> str:
    return with_tables(query, "pipeline_latency", "as_of")


def _kpi(query: str) -> str:
    return with_tables(query, "pipeline_kpi", "as_of")


def _hourly(measure: str, source: str = "sensor_data") -> str:
    return (
        f"SELECT {bucket('1 hour')} AS hour, sensor_id, {r(f'avg({measure})', f'avg_{measure}')} "
        f"FROM {source} GROUP BY 1, 2"
    )


def _histogram(measure: str, low: int, high: int, name: str, limit: str = "") -> str:
    return (
        f"SELECT {bucket('1 minute')} AS minute, "
        f"cast(floor(({measure} - {low}) / (({high} - {low}) / 10e0)) + 1 AS bigint) AS {name}, count(*) AS count "
        f"FROM sensor_data WHERE time BETWEEN {ALWAYS} AND {measure} BETWEEN {low} AND {high} "
        f"GROUP BY 1, 2 ORDER BY 1 DESC, 2 {limit}"
    )


def _rates(window: str, source: str = "sensor_data", places: int = 6) -> str:
    def rate(measure: str, name: str) -> str:
        return (
            f"round(CASE WHEN seconds > 0 THEN ({measure} - p_{measure}) / seconds ELSE 0 END, {places}) + 0e0 AS {name}"
        )

    return f"""
SELECT time, sensor_id, {rate('temperature', 'temp_change_rate')}, {rate('humidity', 'hum_change_rate')}
FROM (SELECT *, (epoch_us(time) - epoch_us(p_time)) / 1e6 AS seconds
      FROM (SELECT time, sensor_id, temperature, humidity,
                   lag(temperature) OVER w AS p_temperature, lag(humidity) OVER w AS p_humidity, lag(time) OVER w AS p_time
            FROM {source} WINDOW w AS ({window} ORDER BY time, event_id)))
WHERE p_time IS NOT NULL"""


def _anomalies(window: str, limit: str = "", source: str = "sensor_data") -> str:
    return f"""
SELECT time, sensor_id, {rs('temperature', 'humidity')},
       CASE WHEN abs(temperature - ta) > 2 * td THEN 'Anomalie de température'
            WHEN abs(humidity - ha) > 2 * hd THEN 'Anomalie d''humidité' ELSE 'Normal' END AS status
FROM (SELECT *, avg(temperature) OVER w AS ta, stddev_samp(temperature) OVER w AS td,
             avg(humidity) OVER w AS ha, stddev_samp(humidity) OVER w AS hd
      FROM {source}
      WINDOW w AS ({window} ORDER BY time, event_id ROWS BETWEEN 10 PRECEDING AND CURRENT ROW))
WHERE abs(temperature - ta) > 2 * td OR abs(humidity - ha) > 2 * hd {limit}"""


STAT_COLUMNS = ("avg_ms", "min_ms", "max_ms", "p95_ms", "p99_ms")
STATS = (
    "avg({v}) AS avg_ms, min({v}) AS min_ms, max({v}) AS max_ms, "
    "quantile_cont({v}, 0.95) AS p95_ms, quantile_cont({v}, 0.99) AS p99_ms"
)


def _kpi_stats(window: str, select: str, where: str = "true") -> str:
    return _kpi(
        f"SELECT {select} FROM {STAGES} LEFT JOIN (SELECT metric_name, {STATS.format(v='value_ms')} FROM pipeline_kpi "
        f"WHERE {recent(window)} GROUP BY metric_name) USING (metric_name) WHERE {where} ORDER BY n"
    )


def _wide_stats(window: str) -> str:
    parts = [
        ("MQTT → Kafka", "mqtt_to_kafka_ms"),
        ("Kafka → Spark", "kafka_to_spark_ms"),
        ("Spark → TimescaleDB", "spark_to_db_ms"),
        ("Total (bout en bout)", "total_latency_ms"),
    ]
    union = " UNION ALL ".join(
        f"SELECT '{label}' AS stage, {STATS.format(v=column)} FROM pipeline_latency WHERE {recent(window)}"
        for label, column in parts
    )
    return _latency(f"SELECT stage, {rs(*STAT_COLUMNS, places=4)} FROM ({union})")


MESSAGE_COLUMNS = ", ".join(
    r(f"cast(json_extract_string({{text}}, '$.{name}') AS double)", name) for name in ("temperature", "humidity", "timestamp")
)
READING_COLUMNS = f"time, sensor_id, {rs('temperature', 'humidity')}"
LATENCY_COLUMNS = ("mqtt_to_kafka_ms", "kafka_to_spark_ms", "spark_to_db_ms", "total_latency_ms")
SUMMARY = ", ".join(
    r(f"{f}({m})", f"{f}_{m}") for m in ("temperature", "humidity") for f in ("avg", "min", "max")
)
LATENCY_MEANS = ", ".join(r(f"avg({c})", c, 4) for c in LATENCY_COLUMNS)
MEANS = f"{r('avg(temperature)', 'avg_temperature')}, {r('avg(humidity)', 'avg_humidity')}"
IMPOSSIBLE = (
    "(temperature IS NULL OR humidity IS NULL OR temperature < 0 OR temperature > 100 OR humidity < 0 OR humidity > 100)"
)
EXTREME = "(temperature > 28 OR temperature < 20 OR humidity > 75 OR humidity < 40)"


def registry() -> dict[str, str]:
    total = "metric_name = 'total_pipeline_latency'"
    stats = rs(*STAT_COLUMNS)
    hourly = _sensor(f"SELECT {bucket('1 hour')} AS hour, {MEANS} FROM sensor_data GROUP BY 1")
    kpi_calculation = _latency(
        f"SELECT bucket AS time, {rs(*LATENCY_COLUMNS, places=4)}, "
        f"{r('(1 - kafka_to_spark_ms / nullif(total_latency_ms, 0)) * 100', 'processing_efficiency_pct', 4)} "
        f"FROM (SELECT {bucket('10 seconds')} AS bucket, {', '.join(f'avg({c}) AS {c}' for c in LATENCY_COLUMNS)} "
        "FROM pipeline_latency WHERE kafka_send_time IS NOT NULL AND spark_receive_time IS NOT NULL GROUP BY 1)"
    )
    kpi_calculation_asof = kpi_calculation.replace(
        "WHERE kafka_send_time IS NOT NULL", f"WHERE {recent('3 minutes')} AND kafka_send_time IS NOT NULL"
    ).replace(NEWEST, MIDDLE)
    found = {
        # sources, sinks, messages
        "parse_readings": with_tables(f"SELECT kafka_offset, {MESSAGE_COLUMNS.format(text='message')} FROM good", "good"),
        "parse_base64_readings": with_tables(
            f"SELECT kafka_offset, {MESSAGE_COLUMNS.format(text='text')} FROM "
            "(SELECT kafka_offset, decode(from_base64(substr(w, 2, length(w) - 2))) AS text FROM "
            "(SELECT kafka_offset, concat('\"', to_base64(encode(message)), '\"') AS w FROM plain)) WHERE json_valid(text)",
            "plain",
        ),
        "dead_letter_split": with_tables("SELECT kafka_offset, message FROM plain WHERE NOT json_valid(message)", "plain"),
        "enrich_readings": with_tables(
            f"SELECT {READING_COLUMNS}, {rs('mqtt_receive_time', 'kafka_send_time')}, kafka_offset FROM streamed", "streamed"
        ),
        "raw_json": with_tables(
            f"SELECT kafka_offset, {MESSAGE_COLUMNS.format(text='message')}, 3 AS fields FROM good", "good"
        ),
        "raw_map": with_tables(
            " UNION ALL ".join(
                f"SELECT kafka_offset, '{name}' AS field, "
                + r(f"cast(json_extract_string(message, '$.{name}') AS double)", "field_value")
                + " FROM good"
                for name in ("temperature", "humidity", "timestamp")
            ),
            "good",
        ),
        "sensor_range_scan": _sensor(
            f"SELECT time, {rs('temperature', 'humidity')} FROM sensor_data WHERE time BETWEEN {ALWAYS} ORDER BY time"
        ),
        "retention_keep": _sensor(
            f"SELECT {READING_COLUMNS} FROM sensor_data WHERE time >= (SELECT now FROM as_of) - INTERVAL '30 days'"
        ),
        "kpi_emission": _kpi(f"SELECT time, metric_name, {rs('value_ms')}, batch_id, message_count FROM pipeline_kpi"),
        "processing_metrics": with_tables(
            "SELECT time, batch_id, sample_size, "
            + rs(
                "processing_time",
                "avg_processing_time",
                "min_processing_time",
                "max_processing_time",
                "stddev_processing_time",
                "median_processing_time",
            )
            + " FROM processing_metrics",
            "processing_metrics",
        ),
        "batch_metadata": _sensor(
            f"SELECT cast(batch AS varchar) AS batch_id, {r('coalesce(avg(temperature), 0)', 'avg_temperature')}, "
            f"{r('coalesce(avg(humidity), 0)', 'avg_humidity')} FROM sensor_data GROUP BY batch"
        ),
        # scans, filters, newest rows
        "sensor_last_hour": _sensor(f"SELECT {READING_COLUMNS} FROM sensor_data WHERE {recent('1 hour')}"),
        "extreme_values": _sensor(
            f"SELECT time, {rs('temperature', 'humidity')} FROM sensor_data WHERE {EXTREME} ORDER BY time DESC LIMIT 20"
        ),
        "extreme_values_all": _sensor(f"SELECT time, {rs('temperature', 'humidity')} FROM sensor_data WHERE {EXTREME}"),
        "integrity_violations": _sensor(
            f"SELECT {READING_COLUMNS} FROM sensor_data WHERE {recent('1 hour')} AND {IMPOSSIBLE}"
        ),
        "integrity_violations_all": _sensor(f"SELECT {READING_COLUMNS} FROM sensor_data WHERE {IMPOSSIBLE}"),
        "latest_reading": _sensor(
            f"SELECT {rs('temperature', 'humidity')}, time FROM sensor_data ORDER BY time DESC LIMIT 1"
        ),
        "latest_readings": _sensor(
            f"SELECT {READING_COLUMNS}, {r('(epoch_us((SELECT now FROM as_of)) - epoch_us(time)) / 1e6', 'seconds_ago')} "
            "FROM sensor_data WHERE time <= (SELECT now FROM as_of) ORDER BY time DESC LIMIT 10"
        ),
        # aggregates
        "period_stats": _sensor(
            "SELECT "
            + ", ".join(
                r(f"{f}({m})", f"{f}_{short}")
                for m, short in (("temperature", "temp"), ("humidity", "hum"))
                for f in ("avg", "max", "min")
            )
            + f" FROM sensor_data WHERE time BETWEEN {ALWAYS}"
        ),
        "hourly_avg": hourly,
        "hourly_avg_temperature": _sensor(_hourly("temperature")),
        "hourly_avg_humidity": _sensor(_hourly("humidity")),
        "hourly_sensor_summary": _sensor(
            f"SELECT {bucket('1 hour')} AS hour, sensor_id, {r('avg(temperature)', 'avg_temp')}, "
            f"{r('min(temperature)', 'min_temp')}, {r('max(temperature)', 'max_temp')}, "
            f"{r('avg(humidity)', 'avg_humidity')}, count(*) AS readings_count "
            f"FROM sensor_data WHERE {recent('24 hours')} GROUP BY 1, 2"
        ),
        "trend_15m": _sensor(
            f"SELECT {bucket('15 minutes')} AS bucket, {MEANS} FROM sensor_data WHERE {recent('6 hours')} GROUP BY 1"
        ),
        "total_measurements": _sensor("SELECT count(*) AS total_measurements FROM sensor_data"),
        "recent_count": _sensor(f"SELECT count(*) AS messages_count FROM sensor_data WHERE {recent('5 minutes')}"),
        "readings_per_minute": _sensor(
            f"SELECT {bucket('1 minute')} AS minute, count(*) AS readings_per_minute FROM sensor_data "
            f"WHERE {recent('30 minutes')} GROUP BY 1"
        ),
        "ingestion_rate": _sensor(
            f"SELECT {bucket('1 minute')} AS minute, count(*) AS messages_per_minute FROM sensor_data "
            f"WHERE {recent('1 hour')} GROUP BY 1"
        ),
        "throughput_30s": _sensor(
            f"SELECT {bucket('30 seconds')} AS minute, count(*) AS messages_per_minute FROM sensor_data "
            f"WHERE {recent('2 minutes')} GROUP BY 1"
        ),
        "throughput_1m": _sensor(f"SELECT {bucket('1 minute')} AS time, count(*) AS messages FROM sensor_data GROUP BY 1"),
        "hourly_volume": _sensor(
            f"SELECT {bucket('1 hour')} AS hour, count(*) AS row_count FROM sensor_data WHERE {recent('24 hours')} GROUP BY 1"
        ),
        "recent_variation": _sensor(
            "SELECT cast(round(cast(max(temperature) - min(temperature) AS decimal(28, 9)), 1) AS double) AS temp_variation, "
            "cast(round(cast(max(humidity) - min(humidity) AS decimal(28, 9)), 1) AS double) AS hum_variation "
            f"FROM sensor_data WHERE {recent('5 minutes')}"
        ),
        "write_latency": _sensor(
            "SELECT "
            + ", ".join(r(f"{f}(age)", f"{f}_write_latency_seconds") for f in ("avg", "max", "min"))
            + " FROM (SELECT (epoch_us((SELECT now FROM as_of)) - epoch_us(time)) / 1e6 AS age FROM sensor_data "
            f"WHERE {recent('5 minutes')})"
        ),
        "temperature_counts": _sensor(
            f"SELECT {rs('temperature')}, count(*) AS count FROM sensor_data WHERE {recent('1 hour')} GROUP BY sensor_data.temperature"
        ),
        # histograms and heat maps
        "heatmap_unit": _sensor(
            "SELECT cast(floor(temperature) AS bigint) AS temp_bucket, cast(floor(humidity) AS bigint) AS hum_bucket, "
            "count(*) AS count FROM sensor_data GROUP BY 1, 2"
        ),
        "hist_temperature": _sensor(_histogram("temperature", 15, 35, "temp_range", "LIMIT 100")),
        "hist_humidity": _sensor(_histogram("humidity", 30, 90, "hum_range", "LIMIT 100")),
        "hist_temperature_all": _sensor(_histogram("temperature", 15, 35, "temp_range")),
        "hist_humidity_all": _sensor(_histogram("humidity", 30, 90, "hum_range")),
        "hist_2d": _sensor(
            "SELECT cast(floor((temperature - 15) / ((35 - 15) / 20e0)) + 1 AS bigint) AS temp_bucket, "
            "cast(floor((humidity - 30) / ((90 - 30) / 20e0)) + 1 AS bigint) AS hum_bucket, count(*) AS count "
            "FROM sensor_data WHERE temperature BETWEEN 15 AND 35 AND humidity BETWEEN 30 AND 90 GROUP BY 1, 2"
        ),
        "latency_histogram": _latency(
            f"SELECT floor(total_latency_ms / 50) * 50 AS bin_ms, count(*) AS count FROM pipeline_latency "
            f"WHERE {recent('2 minutes')} GROUP BY 1"
        ),
        # windows
        "rate_of_change": _sensor(_rates("PARTITION BY sensor_id")),
        "rate_of_change_global": _sensor(_rates("")),
        "rate_of_change_range": _long(_rates("PARTITION BY sensor_id", f"(SELECT * FROM long_series WHERE {LONG_RANGE})", 9)),
        "anomalies_range": _long(_anomalies("PARTITION BY sensor_id", "", f"(SELECT * FROM long_series WHERE {LONG_RANGE})")),
        "anomalies": _sensor(_anomalies("PARTITION BY sensor_id")),
        "anomalies_hot_sensor": _sensor(_anomalies("PARTITION BY sensor_id")),
        "anomalies_global": _sensor(_anomalies("")),
        "anomalies_top10": _sensor(_anomalies("PARTITION BY sensor_id", "ORDER BY time DESC, event_id DESC LIMIT 10")),
        "processing_series": with_tables(
            f"SELECT time, {rs('processing_time', 'avg_processing_time')} FROM processing_metrics", "processing_metrics"
        ),
        # stage latency
        "stage_latency": _latency(
            "SELECT time, sensor_id, "
            + rs(
                "temperature",
                "humidity",
                "spark_receive_time",
                "mqtt_receive_time",
                "kafka_send_time",
                *LATENCY_COLUMNS,
                places=4,
            )
            + " FROM pipeline_latency"
        ),
        "latency_stats_wide": _wide_stats("2 minutes"),
        "latency_stats_wide_all": _wide_stats("36500 days"),
        "kpi_calculation_10s": kpi_calculation,
        "latency_e2e_30s": _latency(
            f"SELECT {bucket('30 seconds')} AS minute, "
            + ", ".join(r(f"{f}(total_latency_ms)", f"{f}_latency_ms", 4) for f in ("avg", "min", "max"))
            + f" FROM pipeline_latency WHERE {recent('2 minutes')} GROUP BY 1"
        ),
        "latency_evolution": _latency(f"SELECT {bucket('1 minute')} AS minute, {LATENCY_MEANS} FROM pipeline_latency GROUP BY 1"),
        "processing_time_30s": with_tables(
            f"SELECT {bucket('30 seconds')} AS minute, "
            + ", ".join(r(f"{f}(processing_time)", f"{f}_processing_time") for f in ("avg", "min", "max"))
            + f" FROM batches WHERE {recent('2 minutes')} GROUP BY 1",
            "batches",
            "as_of",
        ),
        # batch metrics
        "latency_stats_kpi": _kpi_stats("2 minutes", f"stage, {stats}"),
        "latency_stats_kpi_10m": _kpi_stats("10 minutes", f"stage, {stats}"),
        "latency_stats_kpi_1h": _kpi_stats("1 hour", f"stage, {stats}"),
        "latency_stats_ordered": _kpi_stats("2 minutes", f"stage, {stats}"),
        "stage_avg": _kpi_stats("2 minutes", f"stage, {rs('avg_ms')}", "stage <> 'Total (bout en bout)'"),
        "total_avg": _kpi_stats("2 minutes", rs("avg_ms"), "stage = 'Total (bout en bout)'"),
        "kpi_minute_stats": _kpi(
            f"SELECT metric_name, minute, {rs(*STAT_COLUMNS, places=8)}, sample_count, "
            + r("100.0 * (avg_ms - lag(avg_ms) OVER w) / nullif(lag(avg_ms) OVER w, 0)", "pct_change", 8)
            + f" FROM (SELECT metric_name, {bucket('1 minute')} AS minute, {STATS.format(v='value_ms')}, "
            "count(*) AS sample_count FROM pipeline_kpi GROUP BY 1, 2) "
            "WINDOW w AS (PARTITION BY metric_name ORDER BY minute)"
        ),
        "kpi_total_avg": _kpi(
            f"SELECT {r('avg(value_ms)', 'avg_latency')} FROM pipeline_kpi WHERE {recent('2 minutes')} AND {total}"
        ),
        "kpi_total_p95": _kpi(
            f"SELECT {r('quantile_cont(value_ms, 0.95)', 'p95_latency')} FROM pipeline_kpi "
            f"WHERE {recent('2 minutes')} AND {total}"
        ),
        "kpi_stage_share": _kpi(
            f"SELECT (SELECT now FROM as_of) AS time, {r('avg(value_ms)', 'value')}, metric_name AS metric FROM pipeline_kpi "
            f"WHERE {recent('2 minutes')} AND metric_name IN ('mqtt_to_kafka', 'kafka_to_spark', 'spark_to_timescaledb') "
            "GROUP BY metric_name"
        ),
        "kpi_message_volume": _kpi(
            f"SELECT {bucket('10 seconds')} AS time, cast(sum(message_count) AS bigint) AS count FROM pipeline_kpi "
            f"WHERE {recent('5 minutes')} AND {total} GROUP BY 1"
        ),
        "kpi_heatmap": _kpi(
            f"SELECT {bucket('10 seconds')} AS time_interval, metric_name, {r('avg(value_ms)', 'avg_latency')} "
            f"FROM pipeline_kpi WHERE {recent('1 hour')} GROUP BY 1, 2"
        ),
        "kpi_row_count": _kpi("SELECT count(*) AS row_count FROM pipeline_kpi"),
        "kpi_series": _kpi(
            f"SELECT time, {rs('value_ms')}, metric_name AS metric FROM pipeline_kpi WHERE {recent('10 minutes')}"
        ),
        "kpi_series_wide": _kpi(
            "SELECT time, "
            + ", ".join(
                r(f"max(CASE WHEN metric_name = '{m}' THEN value_ms END)", m)
                for m in ("mqtt_to_kafka", "kafka_to_spark", "spark_to_timescaledb", "total_pipeline_latency")
            )
            + f" FROM pipeline_kpi WHERE {recent('10 minutes')} GROUP BY time"
        ),
        "latest_kpi": _kpi(
            f"SELECT time, metric_name, {rs('value_ms')}, batch_id, message_count FROM pipeline_kpi "
            "ORDER BY time DESC, metric_name DESC LIMIT 10"
        ),
        # monitoring
        "series_reducers": _kpi(
            f"SELECT metric_name, {r('avg(value_ms)', 'mean_value')}, {r('max(value_ms)', 'max_value')}, "
            f"{r('min(value_ms)', 'min_value')}, {r('sum(value_ms)', 'sum_value')}, "
            f"{r('arg_max(value_ms, time)', 'last_value')} FROM pipeline_kpi GROUP BY metric_name"
        ),
        "latency_bands": _kpi(
            f"SELECT time, {rs('value_ms')}, CASE WHEN value_ms >= 1000 THEN 'red' WHEN value_ms >= 500 THEN 'yellow' "
            f"ELSE 'green' END AS band FROM pipeline_kpi WHERE {total}"
        ),
        "alert_latency": _kpi(
            f"SELECT (SELECT now FROM as_of) AS time, {r('avg(value_ms)', 'avg_ms')} FROM pipeline_kpi "
            f"WHERE {recent('5 minutes')} AND {total} HAVING avg(value_ms) > 500"
        ),
        "alert_throughput": with_tables(
            "SELECT minute, coalesce(n, 0) AS messages_per_minute FROM "
            f"(SELECT unnest(generate_series(timestamp '2024-01-01 00:00:00', (SELECT {bucket('1 minute', 'max(time)')} FROM gaps) "
            "- INTERVAL '1 minute', INTERVAL '1 minute')) AS minute) LEFT JOIN "
            f"(SELECT {bucket('1 minute')} AS minute, count(*) AS n FROM gaps GROUP BY 1) USING (minute) "
            "WHERE coalesce(n, 0) < 100",
            "gaps",
        ),
        "alert_errors": with_tables(
            "SELECT minute, cast(sum(dead) AS bigint) AS dead_letters, cast(sum(bad) AS bigint) AS violations, "
            "cast(sum(dead + bad) AS bigint) AS errors FROM ("
            f"SELECT {bucket('1 minute', 'arrival')} AS minute, 1 AS dead, 0 AS bad FROM plain WHERE NOT json_valid(message) "
            f"UNION ALL SELECT {bucket('1 minute')}, 0, 1 FROM sensor_data WHERE {IMPOSSIBLE}) GROUP BY minute",
            "plain",
            "sensor_data",
        ),
        # rollups
        "rollup_range": _long(f"SELECT count(*) AS n, {SUMMARY} FROM long_series WHERE {LONG_RANGE}"),
        "rollup_hourly": _long(
            f"SELECT {bucket('1 hour')} AS time, sensor_id, count(*) AS n, {SUMMARY} FROM long_series WHERE {LONG_RANGE} GROUP BY 1, 2"
        ),
        "rollup_trend": _long(f"SELECT {bucket('15 minutes')} AS bucket, {MEANS} FROM long_series WHERE {LONG_RANGE} GROUP BY 1"),
        "rollup_daily": _long(f"SELECT {bucket('1 day')} AS time, sensor_id, count(*) AS n, {SUMMARY} FROM long_series GROUP BY 1, 2"),
        "rollup_latency": with_tables(
            f"SELECT {bucket('1 minute')} AS minute, {LATENCY_MEANS} FROM long_latency WHERE {LONG_RANGE} GROUP BY 1",
            "long_latency",
        ),
        # SQL names
        "sql_kpi_calculation": kpi_calculation,
        "sql_kpi_calculation_asof": kpi_calculation_asof,
        "sql_latency_stats": _kpi_stats("2 minutes", f"stage, {stats}"),
        "sql_latency_stats_asof": _kpi_stats("10 minutes", f"stage, {stats}").replace(NEWEST, MIDDLE),
        "sql_time_bucket": hourly,
        # streams
        "stream_ingest": with_tables(f"SELECT {READING_COLUMNS} FROM streamed", "streamed"),
        "stream_parquet_sink": with_tables(
            f"SELECT {rs('temperature', 'humidity')}, {r('ep', 'timestamp')}, kafka_offset FROM streamed", "streamed"
        ),
        "stream_fanout": with_tables(
            "SELECT CASE WHEN json_valid(message) THEN 'sensor_data' ELSE 'dead_letters' END AS table_name, "
            'count(*) AS "rows", cast(sum(kafka_offset) AS bigint) AS offset_sum FROM bridged GROUP BY 1',
            "bridged",
        ),
        "stream_kpi": with_tables(
            f"SELECT s.metric_name, (SELECT count(*) FROM streamed) AS message_count FROM {STAGES}", "streamed"
        ),
        "stream_tumbling": with_tables(
            f"SELECT {bucket('1 minute')} AS window_start, sensor_id, count(*) AS readings_count, {MEANS} "
            "FROM streamed GROUP BY 1, 2",
            "streamed",
        ),
        "stream_extremes": with_tables(f"SELECT {READING_COLUMNS} FROM streamed WHERE {EXTREME}", "streamed"),
        "stream_progress": "SELECT 'archive' AS query_name, count(*) AS num_input_rows FROM events",
        "stream_hourly_view": with_tables(
            f"SELECT {bucket('1 hour')} AS hour, sensor_id, {MEANS} FROM streamed GROUP BY 1, 2", "streamed"
        ),
    }
    found["stream_rollup"] = with_tables(
        f"SELECT {bucket('1 hour')} AS hour, sensor_id, count(*) AS n, {SUMMARY} FROM streamed GROUP BY 1, 2", "streamed"
    )
    sums = 'count(*) AS "rows", cast(sum(kafka_offset) AS bigint) AS offset_sum'
    found |= {
        "stream_job_all": with_tables(
            f"SELECT 'sensor_data' AS table_name, {sums} FROM good_batched UNION ALL SELECT 'archive', {sums} FROM good_batched "
            f"UNION ALL SELECT 'dead_letters', {sums} FROM batched WHERE NOT json_valid(message) "
            f"UNION ALL SELECT 'late_readings', {sums} FROM late",
            "late",
        ),
        "stream_batches": with_tables(
            "SELECT cast(part AS bigint) AS batch_id, newest, n AS message_count, "
            "(SELECT count(*) FROM batched b WHERE b.part = w.part AND NOT json_valid(message)) AS dead_count, "
            "(SELECT count(*) FROM late l WHERE l.part = w.part) AS late_count FROM watermarks w",
            "late",
        ),
        "stream_minute_windows": with_tables(
            f"SELECT {bucket('1 minute')} AS window_start, sensor_id, count(*) AS readings_count, {MEANS} FROM good_batched GROUP BY 1, 2",
            "good_batched",
        ),
        "stream_kpi_stamps": with_tables(
            "SELECT cast(part AS bigint) AS batch_id, cast(count(*) AS integer) AS message_count, cast(4 AS bigint) AS metrics, "
            + r("avg((kafka_send_time - mqtt_receive_time) * 1000)", "mqtt_to_kafka_ms", 4)
            + ", "
            + ", ".join(r(f"avg({m})", f"avg_{m}", 4) for m in ("temperature", "humidity"))
            + " FROM good_batched GROUP BY part",
            "good_batched",
        ),
        "stream_alerts": with_tables(ALERTS, "watermarks"),
        "compacted_readings": with_tables(
            f"SELECT {READING_COLUMNS}, kafka_offset, cast(part AS bigint) AS batch_id FROM good_batched "
            "WHERE cast(time AS date) = date '2024-01-02'",
            "good_batched",
        ),
        "kpi_by_day": with_tables(
            f"SELECT cast(time AS date) AS date, metric_name, count(*) AS n, {r('avg(value_ms)', 'avg_ms')}, {r('max(value_ms)', 'max_ms')} "
            "FROM long_kpi GROUP BY 1, 2",
            "long_kpi",
        ),
        "retention_7d": with_tables(
            "SELECT cast(time AS date) AS date, count(*) AS n, cast(sum(event_id) AS bigint) AS number_sum, min(time) AS first "
            "FROM sparse_series WHERE cast(time AS date) >= (SELECT cast(max(time) - INTERVAL '7 days' AS date) FROM sparse_series) GROUP BY 1",
            "sparse_series",
        ),
    }
    found["sql_minute_stats"] = found["kpi_minute_stats"]
    # The same windows counted back from the middle of the series.
    for name, base in IN_THE_MIDDLE.items():
        assert NEWEST in found[base]
        found[name] = found[base].replace(NEWEST, MIDDLE)
    return found
