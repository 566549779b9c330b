"""Histograms and heat maps of readings and latencies."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.functions.numbers import equal_bin, unit_cell, width_bin
from sensorweave.functions.timing import since, time_filter
from sensorweave.operators.readings import HOUR, Moment, bucketed
from sensorweave.schemas import HUMIDITY_RANGE, LATENCY_HISTOGRAM_WIDTH_MS, TEMPERATURE_RANGE


def minute_histogram(
    df: DataFrame,
    measure: str,
    low: float,
    high: float,
    name: str,
    bins: int = 10,
    start: Moment = None,
    end: Moment = None,
    n: int | None = 100,
) -> DataFrame:
    """Counts per minute and bin, newest minute first; both range ends are inside."""
    rows = time_filter(df, start, end).where(F.col(measure).between(low, high))
    rows = rows.withColumn(name, equal_bin(F.col(measure), low, high, bins))
    counts = bucketed(rows, "1 minute", "minute", name).agg(F.count(F.lit(1)).alias("count"))
    counts = counts.orderBy(F.col("minute").desc(), name)
    return counts if n is None else counts.limit(n)


def temperature_histogram(df: DataFrame, **options) -> DataFrame:
    return minute_histogram(df, "temperature", *TEMPERATURE_RANGE, "temp_range", **options)


def humidity_histogram(df: DataFrame, **options) -> DataFrame:
    return minute_histogram(df, "humidity", *HUMIDITY_RANGE, "hum_range", **options)


def joint_histogram(df: DataFrame, bins: int = 20, start: Moment = None, end: Moment = None) -> DataFrame:
    temperature, humidity = F.col("temperature"), F.col("humidity")
    rows = time_filter(df, start, end).where(temperature.between(*TEMPERATURE_RANGE) & humidity.between(*HUMIDITY_RANGE))
    return (
        rows.groupBy(
            equal_bin(temperature, *TEMPERATURE_RANGE, bins).alias("temp_bucket"),
            equal_bin(humidity, *HUMIDITY_RANGE, bins).alias("hum_bucket"),
        )
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("temp_bucket", "hum_bucket")
    )


def unit_heatmap(df: DataFrame, start: Moment = None, end: Moment = None) -> DataFrame:
    return (
        time_filter(df, start, end)
        .groupBy(unit_cell(F.col("temperature")).alias("temp_bucket"), unit_cell(F.col("humidity")).alias("hum_bucket"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("temp_bucket", "hum_bucket")
    )


def temperature_counts(df: DataFrame, as_of: Moment = None, window: dt.timedelta = HOUR) -> DataFrame:
    rows = since(df, window, as_of)
    return rows.groupBy("temperature").agg(F.count(F.lit(1)).alias("count")).orderBy("temperature")


def latency_histogram(latency: DataFrame, as_of: Moment = None, window: dt.timedelta = dt.timedelta(minutes=2)) -> DataFrame:
    """Counts of the total latency in fixed-width bins."""
    lower = width_bin(F.col("total_latency_ms"), LATENCY_HISTOGRAM_WIDTH_MS)
    rows = since(latency, window, as_of).where(F.col("total_latency_ms").isNotNull())
    return rows.groupBy(lower.alias("bin_ms")).agg(F.count(F.lit(1)).alias("count")).orderBy("bin_ms")
