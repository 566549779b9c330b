"""Series reducers, threshold bands and alert rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.functions.numbers import band
from sensorweave.functions.timing import resolve_as_of, time_bounds, time_bucket, time_filter, time_literal
from sensorweave.operators.kpi import latency_stats
from sensorweave.operators.readings import MINUTE, Moment, bucket_counts, violates_integrity
from sensorweave.schemas import (
    LATENCY_ALERT_MS,
    LATENCY_BANDS_MS,
    LATENCY_BASE_BAND,
    THROUGHPUT_ALERT_PER_MINUTE,
    TOTAL_STAGE,
)


def series_reducers(series: DataFrame, key: str = "metric", value: str = "value_ms", time: str = "time") -> DataFrame:
    """mean, max, min, sum and last non-null value of each series."""
    present = F.when(F.col(value).isNotNull(), F.col(time))
    return series.groupBy(key).agg(
        F.avg(value).alias("mean_value"),
        F.max(value).alias("max_value"),
        F.min(value).alias("min_value"),
        F.sum(value).alias("sum_value"),
        F.max_by(value, present).alias("last_value"),
    )


def latency_bands(df: DataFrame, value: str) -> DataFrame:
    return df.withColumn("band", band(F.col(value), LATENCY_BANDS_MS, LATENCY_BASE_BAND))


def latency_alert(
    kpi: DataFrame,
    as_of: Moment = None,
    window: dt.timedelta = 5 * MINUTE,
    threshold_ms: float = LATENCY_ALERT_MS,
) -> DataFrame:
    """One row when the mean total latency of the window is above the threshold."""
    as_of = resolve_as_of(kpi, as_of)
    total = latency_stats(kpi, as_of, window).where(F.col("stage") == TOTAL_STAGE)
    return total.where(F.col("avg_ms") > F.lit(threshold_ms)).select(time_literal(kpi, as_of).alias("time"), "avg_ms")


def minute_spine(df: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Every minute from ``start``'s to ``end``'s, one row each, built in parallel."""
    first, last = (moment.replace(second=0, microsecond=0) for moment in (start, end))
    minutes = int((last - first) / MINUTE) + 1
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))
    return df.sparkSession.range(minutes).select((time_literal(df, first) + step).alias("minute"))


def throughput_alert(
    df: DataFrame,
    start: Moment = None,
    end: Moment = None,
    threshold: int = THROUGHPUT_ALERT_PER_MINUTE,
) -> DataFrame:
    """Complete minutes with fewer readings than ``threshold``; silent minutes count 0.

    The range defaults to the table's own first and last reading. A minute is judged
    if the range covers all of it or, at the start, begins within it; the minute that
    holds the end is still filling and is left out.
    """
    if start is None or end is None:
        low, high = time_bounds(df)
        start, end = start or low, end or high
    if start is None or end is None:
        return bucket_counts(df.limit(0), "1 minute")
    first, stop = (moment.replace(second=0, microsecond=0) for moment in (start, end))
    if first >= stop:
        return bucket_counts(df.limit(0), "1 minute")
    counts = bucket_counts(time_filter(df, first, stop).where(F.col("time") < time_literal(df, stop)), "1 minute")
    filled = minute_spine(df, first, stop - MINUTE).join(counts, "minute", "left")
    filled = filled.withColumn("messages_per_minute", F.coalesce("messages_per_minute", F.lit(0).cast("long")))
    return filled.where(F.col("messages_per_minute") < threshold).orderBy("minute")


def error_alert(
    readings: DataFrame,
    dead: DataFrame,
    dead_time: str = "kafka_timestamp",
    start: Moment = None,
    end: Moment = None,
) -> DataFrame:
    """Minutes with malformed messages or impossible readings, and how many.

    A malformed message has no time of its own and counts at its arrival. Both
    inputs are filtered to the range before they are counted.
    """
    readings = time_filter(readings, start, end)
    dead = time_filter(dead, start, end, dead_time)
    violations = readings.where(violates_integrity()).select(
        time_bucket("1 minute").alias("minute"), F.lit(0).alias("dead"), F.lit(1).alias("bad")
    )
    letters = dead.select(time_bucket("1 minute", dead_time).alias("minute"), F.lit(1).alias("dead"), F.lit(0).alias("bad"))
    return (
        violations.unionByName(letters)
        .groupBy("minute")
        .agg(F.sum("dead").alias("dead_letters"), F.sum("bad").alias("violations"))
        .withColumn("errors", F.col("dead_letters") + F.col("violations"))
        .orderBy("minute")
    )
