"""Table schemas and the fixed names and labels that results must carry."""

from __future__ import annotations

from pyspark.sql import types as T

# Sensor id used when a message names none.
DEFAULT_SENSOR_ID = "sensor-1"

# Metric names stored in the KPI table, in stage order.
MQTT_TO_KAFKA = "mqtt_to_kafka"
KAFKA_TO_SPARK = "kafka_to_spark"
SPARK_TO_STORE = "spark_to_timescaledb"
TOTAL_LATENCY = "total_pipeline_latency"
STAGE_METRICS = (MQTT_TO_KAFKA, KAFKA_TO_SPARK, SPARK_TO_STORE)
ALL_METRICS = STAGE_METRICS + (TOTAL_LATENCY,)

# Stage labels shown for the metrics, in display order.
STAGE_LABELS = {
    MQTT_TO_KAFKA: "MQTT → Kafka",
    KAFKA_TO_SPARK: "Kafka → Spark",
    SPARK_TO_STORE: "Spark → TimescaleDB",
    TOTAL_LATENCY: "Total (bout en bout)",
}
TOTAL_STAGE = STAGE_LABELS[TOTAL_LATENCY]

# Anomaly labels.
TEMPERATURE_ANOMALY = "Anomalie de température"
HUMIDITY_ANOMALY = "Anomalie d'humidité"
NORMAL_STATUS = "Normal"

# Measurement limits of the extreme-value, integrity and histogram rules.
EXTREME_TEMPERATURE = (20.0, 28.0)
EXTREME_HUMIDITY = (40.0, 75.0)
VALID_RANGE = (0.0, 100.0)
TEMPERATURE_RANGE = (15.0, 35.0)
HUMIDITY_RANGE = (30.0, 90.0)

# Alert and display thresholds.
LATENCY_BANDS_MS = ((1000.0, "red"), (500.0, "yellow"))
LATENCY_BASE_BAND = "green"
LATENCY_ALERT_MS = 1000.0
THROUGHPUT_ALERT_PER_MINUTE = 10
LATENCY_HISTOGRAM_WIDTH_MS = 50.0
ROLLING_BATCHES = 500


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


MESSAGE = _struct(
    ("temperature", T.DoubleType()),
    ("humidity", T.DoubleType()),
    ("timestamp", T.DoubleType()),
)

BRIDGED_MESSAGE = _struct(
    ("temperature", T.DoubleType()),
    ("humidity", T.DoubleType()),
    ("timestamp", T.DoubleType()),
    ("mqtt_receive_time", T.DoubleType()),
    ("kafka_send_time", T.DoubleType()),
    ("sensor_id", T.StringType()),
)

KAFKA_RECORD = _struct(
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
    ("topic", T.StringType()),
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
    ("timestamp", T.TimestampType()),
    ("timestampType", T.IntegerType()),
)

SENSOR_DATA = _struct(
    ("time", T.TimestampType()),
    ("sensor_id", T.StringType()),
    ("temperature", T.DoubleType()),
    ("humidity", T.DoubleType()),
    ("raw_data", T.StringType()),
    ("spark_receive_time", T.DoubleType()),
    ("mqtt_receive_time", T.DoubleType()),
    ("kafka_send_time", T.DoubleType()),
)

PROCESSING_METRICS = _struct(
    ("time", T.TimestampType()),
    ("batch_id", T.StringType()),
    ("processing_time", T.DoubleType()),
    ("avg_processing_time", T.DoubleType()),
    ("min_processing_time", T.DoubleType()),
    ("max_processing_time", T.DoubleType()),
    ("stddev_processing_time", T.DoubleType()),
    ("median_processing_time", T.DoubleType()),
    ("sample_size", T.IntegerType()),
)

PIPELINE_KPI = _struct(
    ("time", T.TimestampType()),
    ("metric_name", T.StringType()),
    ("value_ms", T.DoubleType()),
    ("batch_id", T.StringType()),
    ("message_count", T.IntegerType()),
    ("metadata", T.StringType()),
)
