"""Hand-computed edges of the operators."""

import datetime as dt

import pytest
from instants import T0
from pyspark.sql import functions as F

from sensorweave.operators import histograms, kpi, latency, monitoring, readings, series
from sensorweave.schemas import HUMIDITY_ANOMALY, STAGE_LABELS, TEMPERATURE_ANOMALY, TOTAL_STAGE
from sensorweave.functions.timing import latest_time
from sensorweave.session import list_folders
from sensorweave.sources.tables import read_table, write_sorted


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def seconds(n):
    return T0 + dt.timedelta(seconds=n)


# --- readings ----------------------------------------------------------------

def test_extremes_are_strict(make_readings):
    df = make_readings((0, 28.0, 75.0), (1, 20.0, 40.0), (2, 28.1, 50.0), (3, 19.9, 50.0), (4, 25.0, 75.1), (5, 25.0, 39.9), (6, None, None))
    assert [r[0] for r in rows(readings.extreme_values(df), "time")] == [seconds(n) for n in (5, 4, 3, 2)]
    assert readings.extreme_values(df, n=2).count() == 2


def test_integrity_catches_missing_and_impossible(make_readings):
    df = make_readings((0, 0.0, 100.0), (1, None, 50.0), (2, 20.0, None), (3, -0.1, 50.0), (4, 20.0, 100.1))
    assert readings.integrity_violations(df).count() == 4
    assert readings.integrity_violations(df, window=None).count() == 4


def test_variation_rounds_half_away_from_zero(make_readings):
    df = make_readings((0, 20.0, 40.0), (60, 20.25, 40.04), (-301, 90.0, 90.0))
    assert rows(readings.recent_variation(df), "temp_variation", "hum_variation") == [(0.3, 0.0)]


def test_statistics_of_no_rows(make_readings):
    empty = make_readings((0, 1.0, 1.0)).where("false")
    assert tuple(readings.period_stats(empty).first()) == (None,) * 6
    assert readings.total_measurements(empty).first()[0] == 0
    assert readings.hourly_average(empty).count() == 0
    assert readings.latest_readings(empty).count() == 0
    assert monitoring.throughput_alert(empty).count() == 0


def test_buckets_start_on_the_clock(make_readings):
    df = make_readings((0, 1.0, 1.0), (899.999, 3.0, 3.0), (900, 5.0, 5.0))
    got = rows(readings.trend(df), "bucket", "avg_temperature")
    assert got == [(T0, 2.0), (seconds(900), 5.0)]


def test_newest_rows_and_ages(make_readings):
    df = make_readings(*[(n, float(n), 1.0) for n in range(15)])
    got = rows(readings.latest_readings(df), "temperature", "seconds_ago")
    assert got == [(float(14 - n), float(n)) for n in range(10)]
    assert readings.latest_reading(df).first().temperature == 14.0


def test_write_latency(make_readings):
    df = make_readings((0, 1.0, 1.0), (10, 1.0, 1.0))
    row = readings.write_latency(df, as_of=seconds(20)).first()
    assert tuple(row) == (15.0, 20.0, 10.0)


# --- histograms --------------------------------------------------------------

def test_histogram_edges(make_readings):
    df = make_readings((0, 15.0, 30.0), (1, 35.0, 90.0), (2, 35.1, 90.1), (3, 14.9, 29.9), (60, 16.9, 35.9))
    assert rows(histograms.temperature_histogram(df), "minute", "temp_range", "count") == [
        (seconds(60), 1, 1),
        (T0, 1, 1),
        (T0, 11, 1),
    ]
    assert rows(histograms.humidity_histogram(df, n=2), "hum_range") == [(1,), (1,)]
    assert rows(histograms.joint_histogram(df), "temp_bucket", "hum_bucket", "count") == [(1, 1, 1), (2, 2, 1), (21, 21, 1)]


def test_histogram_counts_every_row_in_range(make_readings):
    df = make_readings(*[(n, 10.0 + n % 30, 25.0 + n % 70) for n in range(300)])
    counted = histograms.temperature_histogram(df, n=None).agg(F.sum("count")).first()[0]
    assert counted == df.where("temperature BETWEEN 15 AND 35").count()


def test_unit_cells_keep_missing_and_negative(make_readings):
    df = make_readings((0, -0.5, 0.5), (1, None, 0.9))
    assert sorted(rows(histograms.unit_heatmap(df), "temp_bucket", "hum_bucket", "count"), key=str) == [(-1, 0, 1), (None, 0, 1)]


# --- windows -----------------------------------------------------------------

def rates(df, **options):
    return rows(series.rate_of_change(df, **options).orderBy("time"), "temp_change_rate", "hum_change_rate")


def test_rates(make_readings):
    df = make_readings((0, 20.0, 50.0), (2, 21.0, 40.0), (4, None, 40.0), (6, 25.0, 41.0))
    assert rates(df) == [(0.5, -5.0), (None, 0.0), (None, 0.5)]
    assert rates(df.limit(1)) == []


def test_rate_of_equal_times_is_zero(make_readings):
    assert rates(make_readings((0, 20.0, 50.0), (0, 30.0, 60.0))) == [(0.0, 0.0)]


def test_rates_per_sensor_and_over_all(make_readings):
    df = make_readings((0, 20.0, 50.0, "a"), (1, 30.0, 60.0, "b"), (2, 22.0, 50.0, "a"))
    assert rates(df) == [(1.0, 0.0)]
    assert rates(df, keys=()) == [(10.0, 10.0), (-8.0, -10.0)]


def test_rates_do_not_see_clock_changes(spark):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 10 s apart, across the hour that is skipped.
        df = spark.sql("""SELECT timestamp_micros(us) AS time, 's' AS sensor_id, t AS temperature, t AS humidity
                          FROM VALUES (1710053995000000L, 1.0D), (1710054005000000L, 2.0D) AS v(us, t)""")
        assert rates(df) == [(0.1, 0.1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def test_one_reading_is_never_anomalous(make_readings):
    assert series.anomalies(make_readings((0, 99.0, 99.0))).count() == 0


def test_spike_is_flagged_and_temperature_wins(make_readings):
    flat = [(n, 20.0, 50.0) for n in range(11)]
    hot = make_readings(*flat, (11, 30.0, 50.0))
    assert rows(series.anomalies(hot), "time", "status") == [(seconds(11), TEMPERATURE_ANOMALY)]
    wet = make_readings(*flat, (11, 20.0, 90.0))
    assert rows(series.anomalies(wet), "time", "status") == [(seconds(11), HUMIDITY_ANOMALY)]
    both = make_readings(*flat, (11, 30.0, 90.0))
    assert rows(series.newest_anomalies(both), "status") == [(TEMPERATURE_ANOMALY,)]


def test_frame_is_the_row_and_ten_before(make_readings):
    # The old spike is 11 rows back, so the frame of the last row does not see it.
    df = make_readings((0, 500.0, 50.0), *[(n, 20.0 + n % 2, 50.0) for n in range(1, 11)], (11, 30.0, 50.0))
    assert seconds(11) in [r[0] for r in rows(series.anomalies(df), "time")]


def test_rolling_statistics_of_batches(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 9.0)], "batch int, processing_time double")
    got = series.rolling_batch_stats(df, ["batch"], size=2).orderBy("batch").collect()
    assert [(r.avg_processing_time, r.median_processing_time, r.sample_size) for r in got] == [(2, 2, 1), (3, 3, 2), (6.5, 6.5, 2)]
    assert got[0].stddev_processing_time == 0.0


# --- latency and KPI ---------------------------------------------------------

@pytest.fixture
def stamped(make_readings):
    df = make_readings((0, 20.0, 50.0), (1, 20.0, 50.0), (100, 20.0, 50.0))
    end = df.select("*", latency.epoch_seconds(df).alias("_end"))
    kept = F.col("time") != F.lit(seconds(1).isoformat(sep=" ")).cast("timestamp_ntz")
    return end.select(
        "time",
        "sensor_id",
        "temperature",
        "humidity",
        F.when(kept, F.col("_end") - 1.75).alias("mqtt_receive_time"),
        (F.col("_end") - 1.5).alias("kafka_send_time"),
        (F.col("_end") - 1.0).alias("spark_receive_time"),
    )


def test_stage_latency(stamped):
    got = rows(latency.stage_latency(stamped), *latency.STAGE_COLUMNS)
    assert got == [(250.0, 500.0, 1000.0, 1750.0)] * 2


def test_total_is_the_sum_of_the_stages(stamped):
    *stages, total = latency.stage_latency(stamped).select(*latency.STAGE_COLUMNS).first()
    assert sum(stages) == total


def test_stored_column_is_a_parameter(stamped):
    later = stamped.withColumn("stored_at", F.col("time") + F.expr("INTERVAL '1' SECOND"))
    row = latency.stage_latency(later.withColumn("time", F.col("stored_at")), "stored_at").first()
    assert row.total_latency_ms == 2750.0


def test_kpi_calculation(stamped):
    got = latency.kpi_calculation(stamped).collect()
    assert [(r.time, r.kafka_to_spark_ms) for r in got] == [(seconds(0), 500.0), (seconds(100), 500.0)]
    assert got[0].processing_efficiency_pct == pytest.approx((1 - 500 / 1750) * 100)


def test_efficiency_without_total_is_null(stamped):
    no_delay = stamped.withColumn("mqtt_receive_time", latency.epoch_seconds(stamped))
    assert latency.kpi_calculation(no_delay, window=None).first().processing_efficiency_pct is None


def test_wide_statistics_keep_all_stages(stamped):
    got = latency.latency_stats_wide(latency.stage_latency(stamped.where("false"))).collect()
    assert [r.stage for r in got] == list(STAGE_LABELS.values())
    assert all(r.avg_ms is None and r.p99_ms is None for r in got)


def test_latency_histogram(stamped):
    assert rows(histograms.latency_histogram(latency.stage_latency(stamped)), "bin_ms", "count") == [(1750.0, 2)]


def test_kpi_statistics_keep_empty_stages(make_kpi):
    df = make_kpi((0, "mqtt_to_kafka", 10.0), (1, "mqtt_to_kafka", 20.0), (1, "other", 5.0), (-200, "kafka_to_spark", 9.0))
    got = kpi.latency_stats(df).collect()
    assert [(r.stage, r.avg_ms) for r in got] == [
        ("MQTT → Kafka", 15.0),
        ("Kafka → Spark", None),
        ("Spark → TimescaleDB", None),
        (TOTAL_STAGE, None),
    ]
    assert got[0].p95_ms == pytest.approx(19.5) and got[0].min_ms == 10.0
    assert [r.stage for r in latency.stage_averages(kpi.latency_stats(df)).collect()] == list(STAGE_LABELS.values())[:3]
    assert rows(latency.total_average(kpi.latency_stats(df)), "avg_ms") == [(None,)]


@pytest.mark.parametrize("small", [False, True])
def test_total_p95(make_kpi, small):
    df = make_kpi(*[(n, "total_pipeline_latency", float(n)) for n in range(101)])
    assert rows(kpi.total_p95(df, small_groups=small), "p95_latency") == [(95.0,)]
    assert rows(kpi.total_p95(df.where("false"), small_groups=small), "p95_latency") == [(None,)]


def test_minute_statistics_change(make_kpi):
    df = make_kpi((0, "m", 0.0), (60, "m", 4.0), (120, "m", 5.0), (0, "n", 7.0))
    got = rows(kpi.minute_stats(df), "metric_name", "minute", "sample_count", "pct_change")
    assert got == [("m", T0, 1, None), ("m", seconds(60), 1, None), ("m", seconds(120), 1, 25.0), ("n", T0, 1, None)]


def test_emitted_total_is_the_sum(spark):
    batch = spark.sql(
        "SELECT current_timestamp() AS time, '7' AS batch_id, 3L AS message_count, 50.0D AS mqtt_to_kafka, "
        "20.0D AS kafka_to_spark, 5.0D AS spark_to_timescaledb, '{\"a\":1}' AS metadata"
    )
    got = {r.metric_name: (r.value_ms, r.message_count, r.metadata) for r in kpi.emit_kpis(batch).collect()}
    assert got == {
        "spark_to_timescaledb": (5.0, 3, '{"a":1}'),
        "mqtt_to_kafka": (50.0, 3, "{}"),
        "kafka_to_spark": (20.0, 3, "{}"),
        "total_pipeline_latency": (75.0, 3, "{}"),
    }


def test_kpi_row_has_optional_parts(spark):
    row = kpi.kpi_row(spark, "mqtt_to_kafka", 12.5).first()
    assert (row.metric_name, row.value_ms, row.batch_id, row.message_count, row.metadata) == ("mqtt_to_kafka", 12.5, None, None, None)


def test_empty_batch_metadata_is_zero(spark):
    row = spark.range(1).select(kpi.metadata_json(F.lit(None).cast("double"), F.lit(None).cast("double"))).first()
    assert row[0] == '{"avg_temperature":0.0,"avg_humidity":0.0}'


def test_wide_series_has_a_column_per_metric(make_kpi):
    df = make_kpi((0, "mqtt_to_kafka", 1.0), (0, "kafka_to_spark", 2.0), (5, "mqtt_to_kafka", 3.0), (5, "other", 9.0))
    got = rows(kpi.series_wide(df), "time", "mqtt_to_kafka", "kafka_to_spark", "total_pipeline_latency")
    assert got == [(T0, 1.0, 2.0, None), (seconds(5), 3.0, None, None)]


# --- monitoring --------------------------------------------------------------

def test_reducers_skip_missing_last_values(make_kpi):
    df = make_kpi((0, "m", 1.0), (1, "m", 5.0), (2, "m", None))
    row = monitoring.series_reducers(df, key="metric_name").first()
    assert tuple(row) == ("m", 3.0, 5.0, 1.0, 6.0, 5.0)


def test_latency_alert_is_strict(make_kpi):
    assert monitoring.latency_alert(make_kpi((0, "total_pipeline_latency", 1000.0))).count() == 0
    fired = monitoring.latency_alert(make_kpi((0, "total_pipeline_latency", 1000.5)))
    assert rows(fired, "time", "avg_ms") == [(T0, 1000.5)]


def test_throughput_alert_sees_silent_minutes(make_readings):
    full = [(n, 1.0, 1.0) for n in range(10)]
    df = make_readings(*full, *[(180 + n, 1.0, 1.0) for n in range(9)])
    got = rows(monitoring.throughput_alert(df), "minute", "messages_per_minute")
    assert got == [(seconds(60), 0), (seconds(120), 0)]  # the minute of the newest row is still filling
    ranged = monitoring.throughput_alert(df, start=seconds(0), end=seconds(300))
    assert ranged.count() == 4


def test_throughput_alert_on_instants(spark):
    df = spark.sql("SELECT timestamp_micros(1709294400000000L) AS time")
    assert monitoring.throughput_alert(df).count() == 0
    start = dt.datetime(2024, 3, 1, 11, 55)
    assert monitoring.throughput_alert(df, start, start + dt.timedelta(minutes=10)).count() == 10


def test_error_alert_adds_both_kinds(spark, make_readings):
    df = make_readings((0, None, 50.0), (1, 20.0, 50.0), (60, 20.0, 500.0))
    dead = spark.createDataFrame([(seconds(61),), (seconds(120),)], "kafka_timestamp timestamp_ntz")
    got = rows(monitoring.error_alert(df, dead), "minute", "dead_letters", "violations", "errors")
    assert got == [(T0, 0, 1, 1), (seconds(60), 1, 1, 2), (seconds(120), 1, 0, 1)]


def test_windows_end_at_the_given_moment(spark, tmp_path):
    """Rows newer than ``as_of`` do not count, also where the table goes on for days."""
    rows = [(T0 + dt.timedelta(hours=h), "s", float(h), 50.0, h) for h in range(-120, 120)]
    schema = "time timestamp_ntz, sensor_id string, temperature double, humidity double, event_id long"
    path = str(tmp_path / "table")
    write_sorted(spark.createDataFrame(rows, schema), path)
    df = read_table(spark, path)
    assert readings.recent_count(df, T0).first()[0] == 1
    assert readings.hourly_sensor_summary(df, T0).count() == 24
    latest = readings.latest_readings(df, T0).collect()
    assert [r.seconds_ago for r in latest] == [3600.0 * n for n in range(10)]
    assert readings.latest_reading(df, T0).first().time == T0
    assert readings.latest_reading(df).first().time == T0 + dt.timedelta(hours=119)
    assert latest_time(df) == T0 + dt.timedelta(hours=119)
    assert latest_time(df.where(F.col("temperature") < 0)) == T0 - dt.timedelta(hours=1)


def test_the_newest_day_is_found_without_opening_other_files(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(T0 + dt.timedelta(days=d), "s", 1.0, 1.0) for d in range(5)]
    write_sorted(spark.createDataFrame(rows, "time timestamp_ntz, sensor_id string, temperature double, humidity double"), path)
    df = read_table(spark, path)
    for old in list_folders(spark, path):  # what cannot be read must not be needed
        if old.startswith("date=") and old < "date=2024-03-05":
            for file in (tmp_path / "table" / old).glob("*.parquet"):
                file.write_bytes(b"broken")
            for crc in (tmp_path / "table" / old).glob(".*.crc"):
                crc.unlink()
    assert latest_time(df) == T0 + dt.timedelta(days=4)
    assert readings.latest_reading(df).count() == 1
