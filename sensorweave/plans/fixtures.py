"""Sensor tables and raw messages derived by Spark from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.functions.messages import raw_json
from sensorweave.operators.kpi import batch_means, emit_kpis, metadata_json
from sensorweave.operators.series import rolling_batch_stats
from sensorweave.schemas import KAFKA_TO_SPARK, MQTT_TO_KAFKA, SPARK_TO_STORE

EVENTS = "events.parquet"
FIRST_MICROS = 1_704_067_200_000_000


# Columns used here; a stated schema saves the pass that would infer it.
EVENTS_SCHEMA = "event_id long, user_id long, value double, props string"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/{EVENTS}")


def events_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", EVENTS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(sf_dir)


def readings(rows: DataFrame, step_ms: int = 500) -> DataFrame:
    """Events re-timed to one reading per ``step_ms``, with stage stamps.

    The storage time is the reading's own time, so all latencies are positive.
    """
    k = F.get_json_object("props", "$.k").cast("long")
    base = rows.select(
        "event_id",
        "user_id",
        "value",
        k.alias("k"),
        (F.col("event_id") * step_ms + k).alias("ms"),
        (F.col("user_id") % 40 + 1).alias("d1"),
        (k % 200 + 5).alias("d2"),
        (F.col("event_id") % 1100 + 10).alias("d3"),
    )
    time = F.expr("timestamp_ntz'2024-01-01 00:00:00' + ms * INTERVAL '0.001' SECOND")
    ep = (F.lit(FIRST_MICROS) + F.col("ms") * 1000) / F.lit(1e6)

    def missing(every: int, value: Column) -> Column:
        return F.when(F.col("event_id") % every != 0, value)

    def earlier(delay: Column) -> Column:
        return F.col("ep") - delay / F.lit(1000.0)

    d1, d2, d3 = F.col("d1"), F.col("d2"), F.col("d3")
    return base.withColumn("ep", ep).select(
        time.alias("time"),
        F.concat(F.lit("sensor-"), (F.col("user_id") % 5 + 1).cast("string")).alias("sensor_id"),
        missing(211, F.lit(15.0) + F.col("value") / F.lit(5.0)).alias("temperature"),
        missing(223, F.lit(30.0) + F.col("k") * F.lit(0.75)).alias("humidity"),
        missing(101, earlier(d1 + d2 + d3)).alias("mqtt_receive_time"),
        earlier(d2 + d3).alias("kafka_send_time"),
        earlier(d3).alias("spark_receive_time"),
        "event_id",
        "d1",
        "d2",
        "d3",
        "ep",
    )


def sensor_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(events(spark, sf_dir))


def long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per half minute: days of them where ``sensor_data`` has hours."""
    return readings(events(spark, sf_dir), 30_000)


def with_gaps(rows: DataFrame) -> DataFrame:
    """Readings with silent minutes (every seventh) and slow ones (every fifth has half of its rows)."""
    minute = F.expr("event_id div 120")
    slow = (minute % 5 == 1) & (F.col("event_id") % 2 == 1)
    return rows.where((minute % 7 != 3) & ~slow)


def with_batch(rows: DataFrame) -> DataFrame:
    return rows.withColumn("batch", F.expr("event_id div 10"))


def pipeline_kpi(rows: DataFrame) -> DataFrame:
    """KPI rows of batches of ten readings."""
    batches = (
        with_batch(rows)
        .groupBy("batch")
        .agg(
            F.max("time").alias("time"),
            F.count(F.lit(1)).alias("message_count"),
            F.avg("d1").alias(MQTT_TO_KAFKA),
            F.avg("d2").alias(KAFKA_TO_SPARK),
            F.avg("d3").alias(SPARK_TO_STORE),
            metadata_json(F.avg("temperature"), F.avg("humidity")).alias("metadata"),
        )
        .withColumn("batch_id", F.col("batch").cast("string"))
    )
    return emit_kpis(batches)


def batch_times(rows: DataFrame) -> DataFrame:
    return (
        with_batch(rows)
        .groupBy("batch")
        .agg(F.max("time").alias("time"), (F.avg("d3") / F.lit(1000.0)).alias("processing_time"))
    )


def processing_metrics(rows: DataFrame, block_rows: int | None = None) -> DataFrame:
    stats = rolling_batch_stats(batch_times(rows), ["batch"], block_rows=block_rows)
    return stats.withColumn("batch_id", F.col("batch").cast("string")).drop("batch")


def batch_metadata(rows: DataFrame) -> DataFrame:
    return batch_means(with_batch(rows).withColumn("batch_id", F.col("batch").cast("string")))


# --- raw messages ------------------------------------------------------------

def plain_messages(rows: DataFrame) -> DataFrame:
    """Readings without gaps as JSON text, some of it malformed."""
    k = F.get_json_object("props", "$.k").cast("long")
    fields = rows.select(
        "event_id",
        "user_id",
        (F.lit(15.0) + F.col("value") / F.lit(5.0)).alias("temperature"),
        (F.lit(30.0) + k * F.lit(0.75)).alias("humidity"),
        ((F.lit(FIRST_MICROS) + (F.col("event_id") * 500 + k) * 1000) / F.lit(1e6)).alias("timestamp"),
    )
    message = F.when(F.col("event_id") % 97 == 0, "not json").otherwise(raw_json())
    return _as_records(fields.withColumn("message", message), "timestamp")


def bridged_messages(rows: DataFrame, step_ms: int = 500) -> DataFrame:
    """Readings with stamps and sensor id as JSON text, some of it malformed."""
    fields = F.struct(
        "temperature", "humidity", F.col("ep").alias("timestamp"), "mqtt_receive_time", "kafka_send_time", "sensor_id"
    )
    message = F.when(F.col("event_id") % 97 == 0, "not json").otherwise(F.to_json(fields))
    return _as_records(readings(rows, step_ms).withColumn("message", message), "ep")


def is_late(number: Column) -> Column:
    """Messages that arrive after all others."""
    return number % 50 == 7


def message_parts(rows: DataFrame, newest: int) -> list[DataFrame]:
    """Messages half a minute apart in the order of their arrival: the first half, the second half, the late ones.
    Of every fourteen minutes two are silent."""
    records = bridged_messages(rows, 30_000).where("offset div 4 % 7 <> 3")
    late, first = is_late(F.col("offset")), F.col("offset") * 2 <= newest
    return [records.where(~late & first), records.where(~late & ~first), records.where(late)]


def base64_wrapped(records: DataFrame) -> DataFrame:
    wrapped = F.concat(F.lit('"'), F.base64("value"), F.lit('"'))
    return records.withColumn("value", wrapped.cast("binary"))


def _as_records(df: DataFrame, arrival: str) -> DataFrame:
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("message").cast("binary").alias("value"),
        F.lit("sensor-data").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_micros(F.round(F.col(arrival) * F.lit(1e6)).cast("long")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
