"""Stateless part of the stream: parse, split, archive, console."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from sensorweave.config import IngestConfig
from sensorweave.functions.messages import enrich, good_rows, instant, parse_messages
from sensorweave.functions.timing import DATE, with_date
from sensorweave.operators.readings import is_extreme
from sensorweave.sources.kafka import with_coordinates


def parsed_stream(records: DataFrame, config: IngestConfig) -> DataFrame:
    """Kafka-shaped records with their message fields and ``is_valid``."""
    return parse_messages(with_coordinates(records), codec=config.codec)


def reading_stream(parsed: DataFrame, config: IngestConfig) -> DataFrame:
    """Valid messages as sensor readings, for sinks that need no batch stamp."""
    return enrich(parsed, F.unix_micros(F.current_timestamp()) / F.lit(1e6), config.default_sensor_id)


def triggered(writer: DataStreamWriter, config: IngestConfig, drain: bool = False) -> DataStreamWriter:
    """``drain`` processes what is there and ends; otherwise the configured interval."""
    if drain:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=config.trigger_interval)


def archive_writer(parsed: DataFrame, config: IngestConfig, table: str = "archive") -> DataStreamWriter:
    """Append-only Parquet archive of the message fields, one folder per day.

    The file sink's own log makes each file appear once across restarts.
    """
    rows = good_rows(parsed).withColumn("time", instant("timestamp"))
    rows = with_date(rows).select("temperature", "humidity", "timestamp", "sensor_id", "kafka_partition", "kafka_offset", DATE)
    return (
        rows.writeStream.queryName(table)
        .format("parquet")
        .outputMode("append")
        .option("path", config.table(table))
        .option("checkpointLocation", config.checkpoint(table))
        .partitionBy(DATE)
    )


def readings_writer(parsed: DataFrame, config: IngestConfig, table: str = "readings", extremes: bool = False) -> DataStreamWriter:
    """Append-only Parquet table of enriched readings, or of the extreme ones only."""
    rows = reading_stream(parsed, config)
    rows = rows.where(is_extreme()) if extremes else rows
    return (
        with_date(rows)
        .writeStream.queryName(table)
        .format("parquet")
        .outputMode("append")
        .option("path", config.table(table))
        .option("checkpointLocation", config.checkpoint(table))
        .partitionBy(DATE)
    )


def console_writer(df: DataFrame, name: str, checkpoint: str) -> DataStreamWriter:
    """Debug output; Spark shows at most 20 rows of a batch."""
    return (
        df.writeStream.queryName(name)
        .format("console")
        .outputMode("append")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
    )
