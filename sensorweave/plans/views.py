"""SQL names for the tables: derived views and table functions that read at call time.

A table given by its path gets a view whose text names the path, so every query lists the
folders anew and sees rows appended since. Views and functions are SQL text over these
names; registering them runs no job and stores nothing.

``percentile`` would keep all distinct values of a group in one task. The statistics here
select the values at the wanted ranks instead, as ``operators.quantiles`` does: numbers are
counted by a coarse code of the same order, and only those whose code holds a wanted rank
are counted one by one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from sensorweave.functions.timing import DATE, is_ntz
from sensorweave.operators.latency import TAIL_QUANTILES, TWO_MINUTES
from sensorweave.schemas import ALL_METRICS, STAGE_LABELS

# Bucket widths are strings such as '10 seconds'; widths up to a day divide it evenly.
TIME_BUCKET = """
CREATE OR REPLACE TEMPORARY FUNCTION time_bucket(width STRING, t TIMESTAMP) RETURNS TIMESTAMP
RETURN timestamp_micros(unix_micros(t) - pmod(unix_micros(t), unix_micros(timestamp_micros(0) + CAST(width AS INTERVAL))))
"""

# Codes of infinity, NaN and a missing value lie beyond those of all numbers.
BEYOND = 1 << 60
# Infinite logarithms have no code; 1100 makes those of the smallest numbers positive, and
# 2^14 steps per power of two split a group finely enough for any size.
ORDER_CODE = f"""
CASE WHEN {{v}} IS NULL THEN {3 * BEYOND} WHEN isnan({{v}}) THEN {2 * BEYOND}
     WHEN {{v}} = double('infinity') THEN {BEYOND} WHEN {{v}} = double('-infinity') THEN -{BEYOND}
     WHEN {{v}} > 0 THEN floor((log2({{v}}) + 1100) * 16384) WHEN {{v}} < 0 THEN -floor((log2(-{{v}}) + 1100) * 16384)
     ELSE 0 END"""


def group_stats_sql(rows: str, keys: Sequence[str], value: str, quantiles: Mapping[str, float] = TAIL_QUANTILES) -> str:
    """Query for avg/min/max, count and interpolated quantiles of ``value`` per ``keys`` of the query ``rows``.

    A missing value counts as a row only; a group without values has NULL statistics. Two
    reads of ``rows``; what is shuffled and sorted are counts.
    """
    by = ", ".join(keys)
    same = " AND ".join(f"c.{k} <=> near.{k}" for k in (*keys, "_code"))
    group = f"PARTITION BY {by}"
    ranks = {f"_{name}_{side}": f"{side}({float(p)}D * (_total - 1))" for name, p in quantiles.items() for side in ("floor", "ceil")}
    wanted = " OR ".join(f"{rank} BETWEEN _first AND _first + _n - 1" for rank in ranks.values())
    # Counted per value: a value covers the ranks from _from up to before _until.
    chosen = ", ".join(f"max(CASE WHEN {rank} >= _from AND {rank} < _until THEN _value END) AS {name}" for name, rank in ranks.items())
    parts = []
    for name, p in quantiles.items():
        low, high, rank = f"_{name}_floor", f"_{name}_ceil", f"{float(p)}D * (_total - 1)"
        part = f"({rank} - floor({rank}))"
        parts.append(f"CASE WHEN {low} = {high} THEN {low} ELSE (1 - {part}) * {low} + {part} * {high} END AS {name}")
    stats = "any_value(_total) AS _total, any_value(_sum) AS _sum, any_value(_low) AS _low, any_value(_high) AS _high, any_value(_rows) AS _rows"
    return f"""
WITH _coded AS (SELECT {by}, {value} AS _v, {ORDER_CODE.format(v=value)} AS _code FROM ({rows})),
_counts AS (
  SELECT {by}, _code, count(_v) AS _n, sum(_v) AS _s, min(_v) AS _l, max(_v) AS _h, count(*) AS _r FROM _coded GROUP BY {by}, _code),
_placed AS (
  SELECT {by}, _code, _n, sum(_n) OVER ({group} ORDER BY _code ROWS UNBOUNDED PRECEDING) - _n AS _first,
         sum(_n) OVER ({group}) AS _total, sum(_s) OVER ({group}) AS _sum, min(_l) OVER ({group}) AS _low,
         max(_h) OVER ({group}) AS _high, sum(_r) OVER ({group}) AS _rows FROM _counts),
_near AS (SELECT * FROM _placed WHERE _total = 0 OR {wanted}),
_values AS (
  SELECT {', '.join(f'c.{k}' for k in keys)}, c._code, c._v AS _value, count(c._v) AS _c, any_value(_first) AS _first, {stats}
  FROM _coded c JOIN _near near ON {same} GROUP BY {', '.join(f'c.{k}' for k in keys)}, c._code, c._v),
_spans AS (
  SELECT *, _first + sum(_c) OVER (PARTITION BY {by}, _code ORDER BY _value ROWS UNBOUNDED PRECEDING) AS _until FROM _values),
_found AS (
  SELECT {by}, {stats}, {chosen}
  FROM (SELECT *, _until - _c AS _from FROM _spans) GROUP BY {by})
SELECT {by}, try_divide(_sum, _total) AS avg_ms, _low AS min_ms, _high AS max_ms, _rows AS sample_count, {', '.join(parts)}
FROM _found"""


def _window_predicate(name: str, dated: bool, column: str = "time") -> str:
    """``as_of - time_window < time <= as_of`` within the function ``name``.

    The day predicate is a day wider on both sides, so that no session zone can lose rows.
    """
    as_of, start = f"{name}.as_of", f"{name}.as_of - {name}.time_window"
    inside = f"{column} > {start} AND {column} <= {as_of}"
    if dated:
        inside += f" AND {DATE} >= CAST({start} - INTERVAL '1' DAY AS DATE) AND {DATE} <= CAST({as_of} + INTERVAL '1' DAY AS DATE)"
    return inside


def _parameters(instant: str) -> str:
    return (
        "time_window INTERVAL DAY TO SECOND DEFAULT INTERVAL '2' MINUTE, "
        f"as_of {instant} DEFAULT CAST(current_timestamp() AS {instant})"
    )


def kpi_function(instant: str, dated: bool) -> str:
    name = "calculate_pipeline_kpis"
    return f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}({_parameters(instant)})
RETURNS TABLE (time TIMESTAMP, mqtt_to_kafka_ms DOUBLE, kafka_to_spark_ms DOUBLE, spark_to_db_ms DOUBLE,
               total_latency_ms DOUBLE, processing_efficiency_pct DOUBLE)
RETURN
  SELECT bucket, m, k, s, l, (1 - k / nullif(l, 0)) * 100
  FROM (SELECT CAST(window(p.time, '10 seconds').start AS TIMESTAMP) AS bucket,
               avg(mqtt_to_kafka_ms) AS m, avg(kafka_to_spark_ms) AS k,
               avg(spark_to_db_ms) AS s, avg(total_latency_ms) AS l
        FROM pipeline_latency AS p
        WHERE {_window_predicate(name, dated, 'p.time')}
          AND kafka_send_time IS NOT NULL AND spark_receive_time IS NOT NULL
        GROUP BY window(p.time, '10 seconds'))
"""


def latency_stats_function(instant: str, dated: bool) -> str:
    name = "get_pipeline_latency_stats"
    metrics = ", ".join(f"'{m}'" for m in ALL_METRICS)
    rows = f"SELECT metric_name, value_ms FROM pipeline_kpi WHERE metric_name IN ({metrics}) AND {_window_predicate(name, dated)}"
    stages = ", ".join(f"({i}, '{m}', '{STAGE_LABELS[m]}')" for i, m in enumerate(ALL_METRICS))
    return f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}({_parameters(instant)})
RETURNS TABLE (stage STRING, avg_ms DOUBLE, min_ms DOUBLE, max_ms DOUBLE, p95_ms DOUBLE, p99_ms DOUBLE)
RETURN
  SELECT stages.stage, avg_ms, min_ms, max_ms, p95_ms, p99_ms
  FROM VALUES {stages} AS stages(stage_order, metric_name, stage)
  LEFT JOIN ({group_stats_sql(rows, ['metric_name'], 'value_ms')}) AS stats ON stats.metric_name = stages.metric_name
  ORDER BY stage_order
"""


def latency_view(ntz: bool, dated: bool) -> str:
    stored = "CAST(CAST(CAST(time - TIMESTAMP_NTZ'1970-01-01 00:00:00' AS INTERVAL SECOND) AS DECIMAL(20, 6)) AS DOUBLE)"
    if not ntz:
        stored = "unix_micros(time) / 1e6D"
    return f"""
CREATE OR REPLACE TEMPORARY VIEW pipeline_latency AS
SELECT time, sensor_id, temperature, humidity, spark_receive_time, mqtt_receive_time, kafka_send_time{f', {DATE}' if dated else ''},
       (kafka_send_time - mqtt_receive_time) * 1000 AS mqtt_to_kafka_ms,
       (spark_receive_time - kafka_send_time) * 1000 AS kafka_to_spark_ms,
       ({stored} - spark_receive_time) * 1000 AS spark_to_db_ms,
       ({stored} - mqtt_receive_time) * 1000 AS total_latency_ms
FROM sensor_data WHERE mqtt_receive_time IS NOT NULL"""


def hourly_view(measure: str) -> str:
    return f"""
CREATE OR REPLACE TEMPORARY VIEW hourly_avg_{measure} AS
SELECT window(time, '1 hour').start AS hour, sensor_id, avg({measure}) AS avg_{measure}
FROM sensor_data GROUP BY window(time, '1 hour'), sensor_id"""


def minute_stats_view() -> str:
    rows = "SELECT metric_name, window(time, '1 minute').start AS minute, value_ms FROM pipeline_kpi"
    stats = group_stats_sql(rows, ["metric_name", "minute"], "value_ms")
    # One row per metric and minute is left, so a metric's series stays small.
    return f"""
CREATE OR REPLACE TEMPORARY VIEW pipeline_kpi_stats AS
SELECT metric_name, minute, avg_ms, min_ms, max_ms, p95_ms, p99_ms, sample_count,
       100.0D * (avg_ms - lag(avg_ms) OVER series) / nullif(lag(avg_ms) OVER series, 0) AS pct_change
FROM ({stats}) WINDOW series AS (PARTITION BY metric_name ORDER BY minute)"""


def _base(spark: SparkSession, name: str, table: DataFrame | str) -> DataFrame:
    if isinstance(table, str):
        quoted = table.replace("`", "``")
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT * FROM parquet.`{quoted}`")
    else:
        table.createOrReplaceTempView(name)
    return spark.table(name)


def register_views(
    spark: SparkSession,
    sensor_data: DataFrame | str,
    pipeline_kpi: DataFrame | str | None = None,
    processing_metrics: DataFrame | str | None = None,
    as_of: dt.datetime | None = None,
    window: dt.timedelta = TWO_MINUTES,
) -> None:
    """Registers the tables, their views and the SQL functions in the session.

    A table is a path, which stays live, or a DataFrame, which is the state it was read in.
    ``window`` and ``as_of`` apply to the view ``pipeline_latency_stats``; without ``as_of``
    it counts back from the newest row at the time it is read. The functions
    ``get_pipeline_latency_stats`` and ``calculate_pipeline_kpis`` count back from now
    unless told otherwise.
    """
    rows = _base(spark, "sensor_data", sensor_data)
    ntz, dated = is_ntz(rows), DATE in rows.columns
    spark.sql(latency_view(ntz, dated))
    for measure in ("temperature", "humidity"):
        spark.sql(hourly_view(measure))
    spark.sql(TIME_BUCKET)
    spark.sql(kpi_function(_instant(ntz), dated))
    if pipeline_kpi is not None:
        rows = _base(spark, "pipeline_kpi", pipeline_kpi)
        ntz, dated = is_ntz(rows), DATE in rows.columns
        spark.sql(minute_stats_view())
        spark.sql(latency_stats_function(_instant(ntz), dated))
        moment = "(SELECT max(time) FROM pipeline_kpi)"
        if as_of is not None:
            moment = f"CAST({_instant(ntz)}'{as_of.isoformat(sep=' ')}' AS {_instant(ntz)})"
        length = f"INTERVAL '{window / dt.timedelta(seconds=1):.6f}' SECOND"
        spark.sql(
            "CREATE OR REPLACE TEMPORARY VIEW pipeline_latency_stats AS "
            f"SELECT * FROM get_pipeline_latency_stats(CAST({length} AS INTERVAL DAY TO SECOND), {moment})"
        )
    if processing_metrics is not None:
        _base(spark, "processing_metrics", processing_metrics)


def _instant(ntz: bool) -> str:
    return "TIMESTAMP_NTZ" if ntz else "TIMESTAMP"
