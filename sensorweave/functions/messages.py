"""Message decoding: bytes to text, JSON to columns, good and dead rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.schemas import BRIDGED_MESSAGE, DEFAULT_SENSOR_ID

CORRUPT = "_malformed"
#: The message as it came, kept for dead letters.
PAYLOAD = "payload"
CODECS = ("json", "base64")
# UNIX seconds of the years 1 to 9999.
STORABLE_SECONDS = (-62135596800.0, 253402300799.0)


def message_text(value: Column, codec: str = "json") -> Column:
    """JSON text of a message.

    ``base64`` messages are a quoted string holding the encoded JSON; text that
    is not base64 gives NULL and so ends among the dead letters.
    """
    text = value.cast("string")
    if codec == "json":
        return text
    if codec == "base64":
        inner = F.substring(text, F.lit(2), F.length(text) - F.lit(2))
        return F.try_to_binary(inner, F.lit("base64")).cast("string")
    raise ValueError(f"codec must be one of {CODECS}")


def parse_messages(
    df: DataFrame,
    value: str = "value",
    schema: T.StructType = BRIDGED_MESSAGE,
    codec: str = "json",
) -> DataFrame:
    """Adds the message fields, the text, the original bytes, and ``is_valid``.

    A message is valid when the whole text is one object that parsed, and it carries
    a timestamp that a table can hold. Text after the object makes it malformed.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    others = [c for c in df.columns if c not in (value, *schema.fieldNames())]
    text = df.select(*others, F.col(value).alias(PAYLOAD), message_text(F.col(value), codec).alias("message"))
    # Unpacked by a generator, because a filter on struct fields would be pushed
    # below the projection and parse every message a second time.
    fields = F.inline(F.array(F.from_json("message", with_corrupt, options)))
    # As the only element of a list, the text can neither go on after its object nor hold two.
    alone = F.json_array_length(F.concat(F.lit("["), F.col("message"), F.lit("]"))) == 1
    valid = F.col(CORRUPT).isNull() & F.col("timestamp").between(*STORABLE_SECONDS) & alone
    parsed = text.select(*others, PAYLOAD, "message", fields)
    return parsed.withColumn("is_valid", F.coalesce(valid, F.lit(False))).drop(CORRUPT)


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where("is_valid").drop("is_valid", "message", PAYLOAD)


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Malformed messages with their coordinates, decoded text and original bytes."""
    keep = [c for c in parsed.columns if c.startswith("kafka_") and c != "kafka_send_time"]
    return parsed.where(~F.col("is_valid")).select(*keep, "message", PAYLOAD)


def instant(seconds: str) -> Column:
    """Timestamp of fractional UNIX seconds, to the nearest microsecond."""
    return F.timestamp_micros(F.round(F.col(seconds) * F.lit(1e6)).cast("long"))


def raw_json(*names: str) -> Column:
    """The three measured fields as JSON text."""
    return F.to_json(F.struct(*(names or ("temperature", "humidity", "timestamp"))))


def raw_map(*names: str) -> Column:
    """The three measured fields as a map."""
    pairs = []
    for name in names or ("temperature", "humidity", "timestamp"):
        pairs += [F.lit(name), F.col(name)]
    return F.create_map(*pairs)


def sensor_or_default(default: str = DEFAULT_SENSOR_ID) -> Column:
    return F.coalesce(F.col("sensor_id"), F.lit(default))


def enrich(parsed: DataFrame, spark_receive_time: Column, default_sensor_id: str = DEFAULT_SENSOR_ID) -> DataFrame:
    """Valid messages as ``sensor_data`` rows; Kafka coordinates are kept when present.

    A message that did not pass the stamping bridge takes the Kafka record
    timestamp as its send time.
    """
    columns = set(parsed.columns)
    send = F.col("kafka_send_time") if "kafka_send_time" in columns else F.lit(None).cast("double")
    if "kafka_timestamp" in columns:
        send = F.coalesce(send, F.unix_micros("kafka_timestamp") / F.lit(1e6))
    receive = F.col("mqtt_receive_time") if "mqtt_receive_time" in columns else F.lit(None).cast("double")
    coordinates = [c for c in ("kafka_partition", "kafka_offset") if c in columns]
    return good_rows(parsed).select(
        instant("timestamp").alias("time"),
        (sensor_or_default(default_sensor_id) if "sensor_id" in columns else F.lit(default_sensor_id)).alias("sensor_id"),
        "temperature",
        "humidity",
        raw_json().alias("raw_data"),
        spark_receive_time.cast("double").alias("spark_receive_time"),
        receive.alias("mqtt_receive_time"),
        send.alias("kafka_send_time"),
        *coordinates,
    )
