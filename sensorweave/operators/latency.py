"""Stage latencies of single readings and their statistics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorweave.functions.timing import epoch_seconds, since, time_filter
from sensorweave.operators.quantiles import group_stats
from sensorweave.operators.readings import MINUTE, Moment, bucketed
from sensorweave.schemas import ALL_METRICS, STAGE_LABELS, TOTAL_STAGE

# Latency columns in stage order, matching the metric order.
STAGE_COLUMNS = ("mqtt_to_kafka_ms", "kafka_to_spark_ms", "spark_to_db_ms", "total_latency_ms")
TAIL_QUANTILES = {"p95_ms": 0.95, "p99_ms": 0.99}
TWO_MINUTES = 2 * MINUTE


def _differences(df: DataFrame, stored: str) -> dict[str, Column]:
    end = epoch_seconds(df, stored)
    stamps = [F.col("mqtt_receive_time"), F.col("kafka_send_time"), F.col("spark_receive_time"), end]
    steps = [(late - early) * 1000 for early, late in zip(stamps, stamps[1:])]
    return dict(zip(STAGE_COLUMNS, [*steps, (end - stamps[0]) * 1000]))


def stage_latency(df: DataFrame, stored: str = "time", kept: Sequence[str] = ()) -> DataFrame:
    """Milliseconds spent per stage, for readings with a receive stamp.

    ``stored`` names the column holding the storage time, ``kept`` further columns to keep.
    """
    columns = ["time", "sensor_id", "temperature", "humidity", "spark_receive_time", "mqtt_receive_time", "kafka_send_time", *kept]
    if "date" in df.columns:
        columns.append("date")
    rows = df.where(F.col("mqtt_receive_time").isNotNull())
    return rows.select(*columns, *[c.alias(name) for name, c in _differences(df, stored).items()])


def _stage_list(df: DataFrame) -> DataFrame:
    rows = ", ".join(f"({i + 1}, '{m}', '{STAGE_LABELS[m]}')" for i, m in enumerate(ALL_METRICS))
    return df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS stages(stage_order, metric_name, stage)")


def with_all_stages(stats: DataFrame) -> DataFrame:
    """One row per stage, in stage order; a stage without data has NULLs."""
    values = [c for c in stats.columns if c != "metric_name"]
    # Both sides hold at most one row per stage.
    joined = _stage_list(stats).join(F.broadcast(stats), "metric_name", "left")
    return joined.orderBy("stage_order").select("stage", *values)


def latency_stats_wide(
    latency: DataFrame,
    as_of: Moment = None,
    window: dt.timedelta = TWO_MINUTES,
    small_groups: bool = False,
) -> DataFrame:
    """avg/min/max/p95/p99 of the four stages, from one scan of the latency rows."""
    pairs = ", ".join(f"'{metric}', {column}" for metric, column in zip(ALL_METRICS, STAGE_COLUMNS))
    long = since(latency, window, as_of).select(F.expr(f"stack(4, {pairs}) AS (metric_name, value_ms)"))
    return with_all_stages(group_stats(long, ["metric_name"], "value_ms", TAIL_QUANTILES, small_groups=small_groups))


def ordered_stats(stats: DataFrame) -> DataFrame:
    """Stage statistics in display order."""
    return _by_stage(stats).select("stage", "avg_ms", "min_ms", "max_ms", "p95_ms", "p99_ms")


def stage_averages(stats: DataFrame) -> DataFrame:
    return _by_stage(stats.where(F.col("stage") != TOTAL_STAGE)).select("stage", "avg_ms")


def total_average(stats: DataFrame) -> DataFrame:
    return stats.where(F.col("stage") == TOTAL_STAGE).select("avg_ms")


def _by_stage(stats: DataFrame) -> DataFrame:
    order = F.lit(len(ALL_METRICS) + 1)
    for i, metric in reversed(list(enumerate(ALL_METRICS))):
        order = F.when(F.col("stage") == STAGE_LABELS[metric], i + 1).otherwise(order)
    return stats.orderBy(order)


def kpi_calculation(df: DataFrame, as_of: Moment = None, window: dt.timedelta | None = TWO_MINUTES) -> DataFrame:
    """Mean latencies per 10 s and the share of the total not spent before processing."""
    stamped = df.dropna(subset=["mqtt_receive_time", "kafka_send_time", "spark_receive_time"])
    rows = stamped if window is None else since(stamped, window, as_of)
    rows = rows.select("time", *[c.alias(name) for name, c in _differences(df, "time").items()])
    means = bucketed(rows, "10 seconds", "bucket").agg(*[F.avg(c).alias(c) for c in STAGE_COLUMNS])
    waiting = F.col("kafka_to_spark_ms") / F.nullif("total_latency_ms", F.lit(0.0))
    return (
        means.withColumn("processing_efficiency_pct", (F.lit(1) - waiting) * 100)
        .withColumnRenamed("bucket", "time")
        .orderBy("time")
    )


def _spread(column: str, avg: str, low: str, high: str) -> list[Column]:
    return [F.avg(column).alias(avg), F.min(column).alias(low), F.max(column).alias(high)]


def end_to_end_latency(latency: DataFrame, as_of: Moment = None, window: dt.timedelta = TWO_MINUTES) -> DataFrame:
    stats = _spread("total_latency_ms", "avg_latency_ms", "min_latency_ms", "max_latency_ms")
    return bucketed(since(latency, window, as_of), "30 seconds", "minute").agg(*stats).orderBy("minute")


def latency_evolution(latency: DataFrame, start: Moment = None, end: Moment = None) -> DataFrame:
    rows = bucketed(time_filter(latency, start, end), "1 minute", "minute")
    return rows.agg(*[F.avg(c).alias(c) for c in STAGE_COLUMNS]).orderBy("minute")


def processing_time_30s(metrics: DataFrame, as_of: Moment = None, window: dt.timedelta = TWO_MINUTES) -> DataFrame:
    stats = _spread("processing_time", "avg_processing_time", "min_processing_time", "max_processing_time")
    rows = since(metrics, window, as_of).select("time", "processing_time")
    return bucketed(rows, "30 seconds", "minute").agg(*stats).orderBy("minute")


def processing_series(metrics: DataFrame, start: Moment = None, end: Moment = None) -> DataFrame:
    return time_filter(metrics, start, end).select("time", "processing_time", "avg_processing_time").orderBy("time")
