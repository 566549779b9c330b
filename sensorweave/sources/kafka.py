"""Kafka message streams and batch reads of the same topic.

The Kafka connector is a separate Spark package; the caller puts it on the
class path. ``record_stream`` reads recorded messages of the same shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.config import IngestConfig
from sensorweave.schemas import KAFKA_RECORD


def kafka_stream(spark: SparkSession, config: IngestConfig) -> DataFrame:
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", config.kafka_servers)
        .option("subscribe", config.topic)
        .option("startingOffsets", config.starting_offsets)
    )
    if config.max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", config.max_offsets_per_trigger)
    if config.min_partitions:
        # Splits the offset range of a busy topic partition over several tasks.
        reader = reader.option("minPartitions", config.min_partitions)
    return reader.load()


def record_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Stream of Parquet files whose rows have the columns of a Kafka record."""
    return spark.readStream.schema(KAFKA_RECORD).options(**options).parquet(path)


def with_coordinates(records: DataFrame) -> DataFrame:
    """Message bytes with key, topic and the other Kafka coordinates under their own names."""
    return records.select(
        F.col("value"),
        F.col("key").alias("kafka_key"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
