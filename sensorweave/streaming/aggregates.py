"""Windowed aggregates kept up to date by the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from sensorweave.config import IngestConfig
from sensorweave.functions.timing import time_bucket
from sensorweave.operators.rollups import Rollup
from sensorweave.sources.tables import overwrite_batch

TUMBLING = "tumbling_windows"
HOURLY = "hourly_partials"
ROLLUP = "rollup"


def tumbling_windows(readings: DataFrame, width: str = "1 minute", lateness: str = "10 minutes") -> DataFrame:
    """Count and means per window and sensor; readings later than ``lateness`` are dropped."""
    return (
        readings.withWatermark("time", lateness)
        .groupBy(F.window("time", width), "sensor_id")
        .agg(
            F.count(F.lit(1)).alias("readings_count"),
            F.avg("temperature").alias("avg_temperature"),
            F.avg("humidity").alias("avg_humidity"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            "sensor_id",
            "readings_count",
            "avg_temperature",
            "avg_humidity",
        )
    )


def tumbling_writer(readings: DataFrame, config: IngestConfig, **options) -> DataStreamWriter:
    """Writes the windows each micro-batch changed under that batch's id."""
    path = config.table(TUMBLING)
    return (
        tumbling_windows(readings, **options)
        .writeStream.queryName(TUMBLING)
        .outputMode("update")
        .option("checkpointLocation", config.checkpoint(TUMBLING))
        .foreachBatch(lambda changed, batch_id: overwrite_batch(changed, path, batch_id))
    )


def read_tumbling(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """Newest version of every window."""
    values = F.struct("readings_count", "avg_temperature", "avg_humidity")
    newest = F.max_by(values, "batch_id").alias("newest")
    versions = spark.read.parquet(config.table(TUMBLING))
    return versions.groupBy("window_start", "sensor_id").agg(newest).select("window_start", "sensor_id", "newest.*")


def hourly_partials(readings: DataFrame) -> DataFrame:
    """Mergeable sums and counts per hour and sensor."""
    return (
        readings.withColumn("hour", time_bucket("1 hour"))
        .groupBy("hour", "sensor_id")
        .agg(
            F.sum("temperature").alias("temperature_sum"),
            F.count("temperature").alias("temperature_count"),
            F.sum("humidity").alias("humidity_sum"),
            F.count("humidity").alias("humidity_count"),
        )
    )


def hourly_writer(readings: DataFrame, config: IngestConfig) -> DataStreamWriter:
    """Stores each micro-batch's partial sums; no stored hour is ever rewritten."""
    path = config.table(HOURLY)
    return (
        readings.writeStream.queryName(HOURLY)
        .outputMode("append")
        .option("checkpointLocation", config.checkpoint(HOURLY))
        .foreachBatch(lambda rows, batch_id: overwrite_batch(hourly_partials(rows), path, batch_id))
    )


def read_hourly(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """Hourly means per sensor merged from the partial sums; late readings count."""

    def mean(name: str):
        return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_count")).alias(f"avg_{name}")

    partials = spark.read.parquet(config.table(HOURLY))
    return partials.groupBy("hour", "sensor_id").agg(mean("temperature"), mean("humidity"))


def stream_rollup(config: IngestConfig) -> Rollup:
    return Rollup(config.table(ROLLUP))


def rollup_writer(readings: DataFrame, config: IngestConfig, merge_every: int = 100) -> DataStreamWriter:
    """Adds each micro-batch to the minute, hour and day partials, late readings included, and
    merges the partials of earlier batches now and then."""
    rollup = stream_rollup(config)

    def add(rows: DataFrame, batch_id: int) -> None:
        rollup.add(rows, batch_id)
        if batch_id % merge_every == merge_every - 1:
            rollup.merge(rows.sparkSession)

    return (
        readings.writeStream.queryName(ROLLUP)
        .outputMode("append")
        .option("checkpointLocation", config.checkpoint(ROLLUP))
        .foreachBatch(add)
    )
