"""Scans, filters, aggregates and top-k reports over sensor readings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorweave.functions.numbers import outside
from sensorweave.functions.timing import DATE, age_seconds, folder_days, resolve_as_of, since, time_bucket, time_filter
from sensorweave.operators.ordering import tie_columns
from sensorweave.schemas import EXTREME_HUMIDITY, EXTREME_TEMPERATURE, VALID_RANGE

HOUR = dt.timedelta(hours=1)
MINUTE = dt.timedelta(minutes=1)
Moment = dt.datetime | None


# --- scans and filters -------------------------------------------------------

def range_scan(df: DataFrame, start: Moment = None, end: Moment = None) -> DataFrame:
    return time_filter(df, start, end).select("time", "temperature", "humidity").orderBy("time")


def last_hour(df: DataFrame, as_of: Moment = None, window: dt.timedelta = HOUR) -> DataFrame:
    return since(df, window, as_of).select("time", "temperature", "humidity", "sensor_id").orderBy("time")


def is_extreme() -> Column:
    return outside(F.col("temperature"), *EXTREME_TEMPERATURE) | outside(F.col("humidity"), *EXTREME_HUMIDITY)


def extreme_values(df: DataFrame, start: Moment = None, end: Moment = None, n: int | None = 20) -> DataFrame:
    """Readings beyond the comfort limits, newest ``n`` first (all when ``n`` is None)."""
    rows = time_filter(df, start, end).where(is_extreme())
    if n is not None:
        rows = rows.orderBy(F.col("time").desc(), *[F.col(c).desc() for c in _reading_ties(df)]).limit(n)
    return rows.select("time", "temperature", "humidity").orderBy(F.col("time").desc())


def violates_integrity() -> Column:
    def bad(name: str) -> Column:
        return F.col(name).isNull() | outside(F.col(name), *VALID_RANGE)

    return bad("temperature") | bad("humidity")


def integrity_violations(df: DataFrame, as_of: Moment = None, window: dt.timedelta | None = HOUR) -> DataFrame:
    """Missing or impossible measurements; ``window=None`` checks the whole table."""
    rows = df if window is None else since(df, window, as_of)
    rows = rows.where(violates_integrity()).select("time", "temperature", "humidity", "sensor_id")
    return rows.orderBy(F.col("time").desc())


# --- newest rows -------------------------------------------------------------

def newest(df: DataFrame, n: int, *ties: str, as_of: Moment = None) -> DataFrame:
    """Newest ``n`` rows, none newer than ``as_of``; ``ties`` decide within an instant.

    On a date-partitioned table days are counted from the newest folder back until
    they hold ``n`` rows, so no file of an older day is opened.
    """
    df = time_filter(df, end=as_of)
    seen = 0
    for day in reversed(folder_days(df)):
        if as_of is not None and day > as_of.date() + dt.timedelta(days=1):
            continue
        seen += df.where(F.col(DATE) == F.lit(day)).count()
        if seen >= n:
            df = df.where(F.col(DATE) >= F.lit(day))
            break
    return df.orderBy(F.col("time").desc(), *[F.col(c).desc() for c in ties]).limit(n)


def _reading_ties(df: DataFrame) -> list[str]:
    return [*tie_columns(df, None), "sensor_id", "temperature", "humidity"]


def latest_reading(df: DataFrame, as_of: Moment = None) -> DataFrame:
    return newest(df, 1, *_reading_ties(df), as_of=as_of).select("temperature", "humidity", "time")


def latest_readings(df: DataFrame, as_of: Moment = None, n: int = 10) -> DataFrame:
    as_of = resolve_as_of(df, as_of)
    age = age_seconds(df, as_of).alias("seconds_ago")
    return newest(df, n, *_reading_ties(df), as_of=as_of).select("time", "temperature", "humidity", "sensor_id", age)


# --- aggregates --------------------------------------------------------------

def period_stats(df: DataFrame, start: Moment = None, end: Moment = None) -> DataFrame:
    return time_filter(df, start, end).agg(
        F.avg("temperature").alias("avg_temp"),
        F.max("temperature").alias("max_temp"),
        F.min("temperature").alias("min_temp"),
        F.avg("humidity").alias("avg_hum"),
        F.max("humidity").alias("max_hum"),
        F.min("humidity").alias("min_hum"),
    )


def bucketed(df: DataFrame, width: str, name: str, *keys: str):
    """Readings grouped by time bucket (and ``keys``); aggregate the result."""
    return df.withColumn(name, time_bucket(width)).groupBy(name, *keys)


def _means() -> list[Column]:
    return [F.avg("temperature").alias("avg_temperature"), F.avg("humidity").alias("avg_humidity")]


def hourly_average(df: DataFrame, start: Moment = None, end: Moment = None) -> DataFrame:
    return bucketed(time_filter(df, start, end), "1 hour", "hour").agg(*_means()).orderBy("hour")


def hourly_sensor_average(df: DataFrame, measure: str) -> DataFrame:
    """Hourly mean of one measure per sensor over the whole table."""
    means = bucketed(df, "1 hour", "hour", "sensor_id").agg(F.avg(measure).alias(f"avg_{measure}"))
    return means.orderBy(F.col("hour").desc(), "sensor_id")


def hourly_sensor_summary(df: DataFrame, as_of: Moment = None) -> DataFrame:
    return (
        bucketed(since(df, 24 * HOUR, as_of), "1 hour", "hour", "sensor_id")
        .agg(
            F.avg("temperature").alias("avg_temp"),
            F.min("temperature").alias("min_temp"),
            F.max("temperature").alias("max_temp"),
            F.avg("humidity").alias("avg_humidity"),
            F.count(F.lit(1)).alias("readings_count"),
        )
        .orderBy(F.col("hour").desc(), "sensor_id")
    )


def trend(df: DataFrame, as_of: Moment = None, width: str = "15 minutes", window: dt.timedelta = 6 * HOUR) -> DataFrame:
    return bucketed(since(df, window, as_of), width, "bucket").agg(*_means()).orderBy("bucket")


def total_measurements(df: DataFrame, start: Moment = None, end: Moment = None) -> DataFrame:
    return time_filter(df, start, end).agg(F.count(F.lit(1)).alias("total_measurements"))


def recent_count(df: DataFrame, as_of: Moment = None, window: dt.timedelta = 5 * MINUTE) -> DataFrame:
    return since(df, window, as_of).agg(F.count(F.lit(1)).alias("messages_count"))


def bucket_counts(df: DataFrame, width: str, name: str = "minute", count: str = "messages_per_minute") -> DataFrame:
    return bucketed(df, width, name).agg(F.count(F.lit(1)).alias(count))


def readings_per_minute(df: DataFrame, as_of: Moment = None) -> DataFrame:
    rows = since(df, 30 * MINUTE, as_of)
    return bucket_counts(rows, "1 minute", count="readings_per_minute").orderBy(F.col("minute").desc())


def ingestion_rate(df: DataFrame, as_of: Moment = None) -> DataFrame:
    return bucket_counts(since(df, HOUR, as_of), "1 minute").orderBy("minute")


def throughput_30s(df: DataFrame, as_of: Moment = None) -> DataFrame:
    return bucket_counts(since(df, 2 * MINUTE, as_of), "30 seconds").orderBy("minute")


def throughput_1m(df: DataFrame, start: Moment = None, end: Moment = None) -> DataFrame:
    return bucket_counts(time_filter(df, start, end), "1 minute", "time", "messages").orderBy("time")


def hourly_volume(df: DataFrame, as_of: Moment = None) -> DataFrame:
    return bucket_counts(since(df, 24 * HOUR, as_of), "1 hour", "hour", "row_count").orderBy("hour")


def recent_variation(df: DataFrame, as_of: Moment = None, window: dt.timedelta = 5 * MINUTE) -> DataFrame:
    """Spread of both measures, rounded half away from zero to one decimal."""

    def spread(name: str, alias: str) -> Column:
        exact = (F.max(name) - F.min(name)).cast("decimal(38,9)")
        return F.round(exact, 1).cast("double").alias(alias)

    return since(df, window, as_of).agg(spread("temperature", "temp_variation"), spread("humidity", "hum_variation"))


def write_latency(df: DataFrame, as_of: Moment = None, window: dt.timedelta = 5 * MINUTE) -> DataFrame:
    as_of = resolve_as_of(df, as_of)
    age = age_seconds(df, as_of)
    return since(df, window, as_of).agg(
        F.avg(age).alias("avg_write_latency_seconds"),
        F.max(age).alias("max_write_latency_seconds"),
        F.min(age).alias("min_write_latency_seconds"),
    )
