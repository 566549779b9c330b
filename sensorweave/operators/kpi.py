"""Batch metrics in long form: emission, statistics and reshaping."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave.functions.numbers import percent_change
from sensorweave.functions.timing import resolve_as_of, since, time_bucket, time_literal
from sensorweave.operators.latency import TAIL_QUANTILES, TWO_MINUTES, with_all_stages
from sensorweave.operators.quantiles import group_stats
from sensorweave.operators.readings import HOUR, MINUTE, Moment, bucketed, newest
from sensorweave.schemas import (
    ALL_METRICS,
    KAFKA_TO_SPARK,
    MQTT_TO_KAFKA,
    PIPELINE_KPI,
    SPARK_TO_STORE,
    STAGE_METRICS,
    TOTAL_LATENCY,
)
from sensorweave.sources.tables import append, create_table


# --- emission ----------------------------------------------------------------

def metadata_json(avg_temperature: Column, avg_humidity: Column, *extra: Column) -> Column:
    """Batch means as JSON; 0 stands for a batch without values."""
    means = [
        F.coalesce(avg_temperature, F.lit(0.0)).alias("avg_temperature"),
        F.coalesce(avg_humidity, F.lit(0.0)).alias("avg_humidity"),
    ]
    return F.to_json(F.struct(*means, *extra))


def emit_kpis(batches: DataFrame) -> DataFrame:
    """Four KPI rows per batch row; the total is the sum of the stages.

    ``batches`` has ``time, batch_id, message_count``, one column per stage
    metric, and ``metadata``, which goes to the storage stage.
    """
    empty = "'{}'"
    total = " + ".join(STAGE_METRICS)
    rows = [
        f"'{SPARK_TO_STORE}', {SPARK_TO_STORE}, metadata",
        f"'{MQTT_TO_KAFKA}', {MQTT_TO_KAFKA}, {empty}",
        f"'{KAFKA_TO_SPARK}', {KAFKA_TO_SPARK}, {empty}",
        f"'{TOTAL_LATENCY}', {total}, {empty}",
    ]
    stacked = F.expr(f"stack(4, {', '.join(rows)}) AS (metric_name, value_ms, metadata)")
    tagged = batches.select("time", "batch_id", F.col("message_count").cast("int").alias("message_count"), stacked)
    return tagged.select("time", "metric_name", "value_ms", "batch_id", "message_count", "metadata")


def kpi_row(
    spark,
    metric_name: str,
    value_ms: float,
    batch_id: str | None = None,
    message_count: int | None = None,
    metadata: str | None = None,
) -> DataFrame:
    """A single KPI row stamped now, ready to append to the KPI table."""
    columns = [
        F.current_timestamp().alias("time"),
        F.lit(metric_name).alias("metric_name"),
        F.lit(value_ms).cast("double").alias("value_ms"),
        F.lit(batch_id).cast("string").alias("batch_id"),
        F.lit(message_count).cast("int").alias("message_count"),
        F.lit(metadata).cast("string").alias("metadata"),
    ]
    return spark.range(0, 1, 1, 1).select(*columns)


def insert_kpi(spark, path: str, metric_name: str, value_ms: float, **fields) -> None:
    """Appends one KPI row stamped now to the day table at ``path``, which is created if missing.

    ``fields`` are the others of ``kpi_row``; a row without a batch gets a name of its own.
    """
    fields.setdefault("batch_id", uuid.uuid4().hex)
    create_table(spark, path, PIPELINE_KPI)
    append(kpi_row(spark, metric_name, value_ms, **fields), path)


def batch_means(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Mean temperature and humidity of each batch."""
    return df.groupBy(batch).agg(
        F.coalesce(F.avg("temperature"), F.lit(0.0)).alias("avg_temperature"),
        F.coalesce(F.avg("humidity"), F.lit(0.0)).alias("avg_humidity"),
    )


# --- statistics --------------------------------------------------------------

def of_metrics(kpi: DataFrame, metrics: Sequence[str]) -> DataFrame:
    return kpi.where(F.col("metric_name").isin(list(metrics)))


def latency_stats(
    kpi: DataFrame,
    as_of: Moment = None,
    window: dt.timedelta = TWO_MINUTES,
    small_groups: bool = False,
    approximate: int | None = None,
) -> DataFrame:
    """avg/min/max/p95/p99 per stage; stages without rows appear with NULLs."""
    rows = of_metrics(since(kpi, window, as_of), ALL_METRICS)
    return with_all_stages(
        group_stats(
            rows,
            ["metric_name"],
            "value_ms",
            TAIL_QUANTILES,
            small_groups=small_groups,
            approximate=approximate,
        )
    )


def minute_stats(kpi: DataFrame, small_groups: bool = False) -> DataFrame:
    """Per metric and minute: statistics and percent change on the previous minute."""
    rows = kpi.select("metric_name", time_bucket("1 minute").alias("minute"), "value_ms")
    stats = group_stats(
        rows, ["metric_name", "minute"], "value_ms", TAIL_QUANTILES, counted=True, small_groups=small_groups
    )
    # One row per metric and minute is left, so a metric's series stays small.
    series = Window.partitionBy("metric_name").orderBy("minute")
    change = percent_change(F.col("avg_ms"), F.lag("avg_ms").over(series))
    return stats.withColumn("pct_change", change).orderBy("metric_name", "minute")


def total_mean(kpi: DataFrame, as_of: Moment = None, window: dt.timedelta = TWO_MINUTES) -> DataFrame:
    rows = of_metrics(since(kpi, window, as_of), [TOTAL_LATENCY])
    return rows.agg(F.avg("value_ms").alias("avg_latency"))


def total_p95(
    kpi: DataFrame,
    as_of: Moment = None,
    window: dt.timedelta = TWO_MINUTES,
    small_groups: bool = False,
) -> DataFrame:
    rows = of_metrics(since(kpi, window, as_of), [TOTAL_LATENCY])
    return group_stats(rows, [], "value_ms", {"p95_latency": 0.95}, small_groups=small_groups).select("p95_latency")


def stage_share(kpi: DataFrame, as_of: Moment = None, window: dt.timedelta = TWO_MINUTES) -> DataFrame:
    as_of = resolve_as_of(kpi, as_of)
    rows = of_metrics(since(kpi, window, as_of), STAGE_METRICS)
    means = rows.groupBy(F.col("metric_name").alias("metric")).agg(F.avg("value_ms").alias("value"))
    return means.select(time_literal(kpi, as_of).alias("time"), "value", "metric").orderBy("metric")


def message_volume(kpi: DataFrame, as_of: Moment = None, window: dt.timedelta = 5 * MINUTE) -> DataFrame:
    rows = of_metrics(since(kpi, window, as_of), [TOTAL_LATENCY]).select("time", "message_count")
    volume = bucketed(rows, "10 seconds", "bucket").agg(F.sum("message_count").alias("count"))
    return volume.withColumnRenamed("bucket", "time").orderBy("time")


def latency_heatmap(kpi: DataFrame, as_of: Moment = None, window: dt.timedelta = HOUR) -> DataFrame:
    means = bucketed(since(kpi, window, as_of), "10 seconds", "time_interval", "metric_name")
    return means.agg(F.avg("value_ms").alias("avg_latency")).orderBy("time_interval", "metric_name")


def row_count(kpi: DataFrame) -> DataFrame:
    return kpi.agg(F.count(F.lit(1)).alias("row_count"))


# --- series and newest rows --------------------------------------------------

def series(kpi: DataFrame, as_of: Moment = None, window: dt.timedelta = 10 * MINUTE) -> DataFrame:
    rows = of_metrics(since(kpi, window, as_of), ALL_METRICS)
    return rows.select("time", "value_ms", F.col("metric_name").alias("metric")).orderBy("time", "metric")


def series_wide(kpi: DataFrame, as_of: Moment = None, window: dt.timedelta = 10 * MINUTE) -> DataFrame:
    """One column per metric; the metric list is fixed, so no extra pass finds it.

    Of several values of one metric at one time the largest is shown.
    """
    rows = of_metrics(since(kpi, window, as_of), ALL_METRICS)
    return rows.groupBy("time").pivot("metric_name", list(ALL_METRICS)).agg(F.max("value_ms")).orderBy("time")


def latest_rows(kpi: DataFrame, n: int = 10, as_of: Moment = None) -> DataFrame:
    return newest(kpi, n, "metric_name", "batch_id", "value_ms", as_of=as_of).select("time", "metric_name", "value_ms", "batch_id", "message_count")
