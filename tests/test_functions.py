import datetime as dt

import pytest
from instants import T0
from pyspark.sql import functions as F

from sensorweave.config import IngestConfig
from sensorweave.functions import messages as msg
from sensorweave.functions import numbers, timing
from sensorweave.schemas import LATENCY_BANDS_MS, MESSAGE


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_equal_bins_include_both_ends(spark):
    rows = [(14.9,), (15.0,), (34.999,), (35.0,), (35.1,)]
    ten = numbers.equal_bin(F.col("x"), 15, 35, 10)
    twenty = numbers.equal_bin(F.col("x"), 15, 35, 20)
    assert values(spark, rows, "x double", ten, twenty) == [(0, 0), (1, 1), (10, 20), (11, 21), (11, 21)]


def test_bands_take_the_highest_step_reached(spark):
    rows = [(0.0,), (499.9,), (500.0,), (999.9,), (1000.0,), (None,)]
    got = values(spark, rows, "x double", numbers.band(F.col("x"), LATENCY_BANDS_MS, "green"))
    assert [g[0] for g in got] == ["green", "green", "yellow", "yellow", "red", None]


def test_percent_change_from_zero_is_null(spark):
    change = numbers.percent_change(F.col("a"), F.col("b"))
    assert values(spark, [(5.0, 0.0), (5.0, 4.0), (5.0, None)], "a double, b double", change) == [(None,), (25.0,), (None,)]


def test_rounding_has_no_negative_zero(spark):
    got = values(spark, [(-0.0000001,)], "x double", numbers.rounded(F.col("x")))[0][0]
    assert str(got) == "0.0"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epochs_ignore_zone_and_clock_changes(spark, zone):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for kind in ("timestamp_ntz", "timestamp"):
            # 02:30 on this day does not exist in New York.
            df = spark.sql("SELECT timestamp_micros(1710037800123456L) AS time")
            if kind == "timestamp_ntz":
                df = df.select(timing.instant_to_ntz("time").alias("time"))
            assert df.select(timing.epoch_seconds(df)).first()[0] == 1710037800.123456
            assert timing.latest_time(df) == dt.datetime(2024, 3, 10, 2, 30, 0, 123456)
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def test_relative_window_is_strict_and_range_inclusive(make_readings):
    micro = 1e-6
    df = make_readings((0, 1.0, 1.0), (micro, 2.0, 2.0), (120, 3.0, 3.0))
    as_of = T0 + dt.timedelta(seconds=120)
    recent = timing.since(df, dt.timedelta(minutes=2), as_of)
    assert sorted(r.temperature for r in recent.collect()) == [2.0, 3.0]
    ranged = timing.time_filter(df, T0, as_of)
    assert ranged.count() == 3
    # Without as_of the newest reading counts.
    assert timing.since(df, dt.timedelta(minutes=2)).count() == 2


def test_empty_table_has_no_recent_rows(make_readings):
    assert timing.since(make_readings((0, 1.0, 1.0)).where("false"), dt.timedelta(hours=1)).count() == 0


MESSAGES = [
    ('{"temperature": 21.5, "humidity": 60.0, "timestamp": 1712921712.123}', True),
    ("not json", False),
    (None, False),
    ("", False),
    ('{"temperature": "warm", "humidity": 60.0, "timestamp": 1712921712.0}', False),
    ('{"humidity": 60.0}', False),
    ('{"temperature": 21.5, "humidity": 60.0, "timestamp": 1712921712.0, "extra": [1]}', True),
    ('{"temperature": 21.5, "timestamp": 1e300}', False),
    ('{"temperature": 21.5, "timestamp": NaN}', False),
    ("[1, 2]", False),
    ('{"timestamp": 1712921712.0', False),
]


@pytest.mark.parametrize("codec", msg.CODECS)
def test_good_and_dead_messages(spark, codec):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(MESSAGES)], "kafka_offset int, text string")
    value = F.col("text") if codec == "json" else F.concat(F.lit('"'), F.base64(F.encode("text", "UTF-8")), F.lit('"'))
    records = df.select("kafka_offset", value.cast("binary").alias("value"))
    parsed = msg.parse_messages(records, schema=MESSAGE, codec=codec)
    good = {r.kafka_offset for r in msg.good_rows(parsed).collect()}
    assert good == {i for i, (_, ok) in enumerate(MESSAGES) if ok}
    dead = {r.kafka_offset for r in msg.dead_letters(parsed).collect()}
    assert dead == {i for i, (_, ok) in enumerate(MESSAGES) if not ok}


def test_text_that_is_not_base64_is_dead(spark):
    records = spark.createDataFrame([(bytearray(b'"%%%not base64%%%"'),), (bytearray(b'"'),)], "value binary")
    parsed = msg.parse_messages(records, schema=MESSAGE, codec="base64")
    assert [r.is_valid for r in parsed.collect()] == [False, False]


def test_unknown_codec_is_refused(spark):
    with pytest.raises(ValueError):
        msg.message_text(F.col("value"), "gzip")


def test_enrichment_defaults(spark):
    text = '{"temperature": 21.5, "humidity": 60.0, "timestamp": 1712921712.123}'
    df = spark.createDataFrame([(bytearray(text.encode()),)], "value binary")
    df = df.withColumn("kafka_timestamp", F.timestamp_micros(F.lit(1712921713000000)))
    row = msg.enrich(msg.parse_messages(df), F.lit(7.0)).first()
    assert (row.sensor_id, row.spark_receive_time, row.kafka_send_time, row.mqtt_receive_time) == (
        "sensor-1",
        7.0,
        1712921713.0,
        None,
    )
    assert row.raw_data == '{"temperature":21.5,"humidity":60.0,"timestamp":1.712921712123E9}'
    assert row.time == dt.datetime.fromtimestamp(1712921712.123)


def test_enrichment_prefers_message_fields(spark):
    text = '{"temperature": 1, "timestamp": 10.5, "sensor_id": "s9", "mqtt_receive_time": 10.6, "kafka_send_time": 10.7}'
    df = spark.createDataFrame([(bytearray(text.encode()),)], "value binary")
    row = msg.enrich(msg.parse_messages(df), F.lit(11.0)).first()
    assert (row.sensor_id, row.temperature, row.humidity, row.mqtt_receive_time, row.kafka_send_time) == (
        "s9",
        1.0,
        None,
        10.6,
        10.7,
    )


def test_raw_map_has_three_entries(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "temperature double, humidity double, timestamp double")
    assert df.select(msg.raw_map()).first()[0] == {"temperature": 1.0, "humidity": 2.0, "timestamp": 3.0}


def test_config_rejects_unknown_settings():
    config = IngestConfig.from_mapping({"table_root": "/a/", "checkpoint_root": "/b", "topic": "t"})
    assert (config.table("x"), config.checkpoint("y"), config.topic) == ("/a/x", "/b/y", "t")
    with pytest.raises(ValueError):
        IngestConfig.from_mapping({"table_root": "/a", "checkpoint_root": "/b", "tpoic": "t"})


@pytest.mark.parametrize("codec", ["json", "base64"])
def test_dead_letters_keep_the_original_bytes(spark, codec):
    good = b'{"temperature": 1.5, "humidity": 2.0, "timestamp": 5.0}'
    texts = [good, good + b" trailing", good + good, good + b"," + good, b'{"temperature": "x"}', b"\xff\xfe", b"", None]
    if codec == "base64":
        import base64

        texts = [t if t is None else b'"' + base64.b64encode(t) + b'"' for t in texts] + [b"plain text", b'"no base64 !"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "kafka_offset int, value binary")
    parsed = msg.parse_messages(df, codec=codec)
    assert [r.kafka_offset for r in msg.good_rows(parsed).collect()] == [0]
    kept = {r.kafka_offset: r.payload for r in msg.dead_letters(parsed).collect()}
    assert {i: None if t is None else bytes(t) for i, t in kept.items()} == {i: t for i, t in enumerate(texts) if i}
