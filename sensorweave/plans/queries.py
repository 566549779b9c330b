"""The registered queries: every operator over tables Spark derives from ``events``.

Relative windows count back from the newest reading. Computed doubles are
rounded so that results compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.config import IngestConfig
from sensorweave.functions import messages as msg
from sensorweave.functions.numbers import rounded
from sensorweave.functions.timing import instant_to_ntz, latest_time
from sensorweave.operators import histograms, kpi, latency, monitoring, readings, series
from sensorweave.plans import fixtures as fx
from sensorweave.plans import store
from sensorweave.plans.views import register_views
from sensorweave.schemas import MESSAGE, MQTT_TO_KAFKA, ROLLING_BATCHES, SPARK_TO_STORE
from sensorweave.session import scratch_path
from sensorweave.sources import tables
from sensorweave.sources.kafka import with_coordinates
from sensorweave.streaming import aggregates, alerts, fanout, ingest, intake
from sensorweave.streaming.progress import ProgressTable

Query = Callable[[SparkSession, str], DataFrame]

# A range that covers the whole series.
START = dt.datetime(2024, 1, 1)
END = dt.datetime(2100, 1, 1)
TIE = ("event_id",)


def shown(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, instants as UTC wall-clock time."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = rounded(column, places)
        elif isinstance(field.dataType, T.TimestampType):
            column = instant_to_ntz(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def middle_time(spark: SparkSession, sf_dir: str) -> dt.datetime:
    """The moment of the reading in the middle of the series: rows before and after it."""
    rows = store.sensor_data(spark, sf_dir).select("event_id", "time")
    newest = rows.agg(F.max("event_id")).first()[0]
    return rows.where(F.col("event_id") == F.lit(newest // 2)).first()["time"]


def _on(
    source: Callable, operator: Callable, places: int = 6, relative: bool = False, middle: bool = False, **options
) -> Query:
    """A query applying ``operator`` to ``source``; relative ones get ``as_of``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = source(spark, sf_dir)
        extra = dict(options)
        if relative:
            extra["as_of"] = middle_time(spark, sf_dir) if middle else latest_time(store.sensor_data(spark, sf_dir))
        return shown(operator(rows, **extra), places)

    return run


def _sensor(operator: Callable, relative: bool = False, **options) -> Query:
    return _on(store.sensor_data, operator, relative=relative, **options)


def _stage_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency.stage_latency(store.sensor_data(spark, sf_dir))


def _latency(operator: Callable, relative: bool = False, **options) -> Query:
    return _on(_stage_latency, operator, places=4, relative=relative, **options)


def _kpi(operator: Callable, relative: bool = False, **options) -> Query:
    return _on(store.pipeline_kpi, operator, relative=relative, **options)


# --- messages ----------------------------------------------------------------

def _parsed(spark: SparkSession, sf_dir: str, codec: str = "json") -> DataFrame:
    records = fx.plain_messages(fx.events(spark, sf_dir))
    if codec == "base64":
        records = fx.base64_wrapped(records)
    return msg.parse_messages(with_coordinates(records), schema=MESSAGE, codec=codec)


def _message_fields(parsed: DataFrame) -> DataFrame:
    return msg.good_rows(parsed).select("kafka_offset", "temperature", "humidity", "timestamp")


def parse_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_message_fields(_parsed(spark, sf_dir)))


def parse_base64_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_message_fields(_parsed(spark, sf_dir, "base64")))


def dead_letter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.dead_letters(_parsed(spark, sf_dir)).select("kafka_offset", "message")


def enrich_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.bridged_messages(fx.events(spark, sf_dir))
    rows = msg.enrich(msg.parse_messages(with_coordinates(records)), F.lit(0.0))
    columns = ["time", "sensor_id", "temperature", "humidity", "mqtt_receive_time", "kafka_send_time", "kafka_offset"]
    return shown(rows.select(*columns))


def raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON column read back, since engines print doubles differently."""
    rows = msg.good_rows(_parsed(spark, sf_dir)).select("kafka_offset", msg.raw_json().alias("raw_data"))
    fields = F.inline(F.array(F.from_json("raw_data", MESSAGE)))
    return shown(rows.select("kafka_offset", F.size(F.json_object_keys("raw_data")).alias("fields"), fields))


def raw_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = msg.raw_map()
    rows = msg.good_rows(_parsed(spark, sf_dir)).select("kafka_offset", F.explode(entries).alias("field", "field_value"))
    return shown(rows)


# --- stored tables -----------------------------------------------------------

def retention_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = tables.retained(store.sensor_data(spark, sf_dir), 30)
    return shown(kept.select("time", "sensor_id", "temperature", "humidity"))


def table_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table_size(spark, store.sensor_data_path(spark, sf_dir))


# --- tables of batches -------------------------------------------------------

def kpi_emission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(fx.pipeline_kpi(store.sensor_data(spark, sf_dir)).drop("metadata"))


def processing_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of half a frame, so that frames reach over two of them at every size."""
    return shown(fx.processing_metrics(store.sensor_data(spark, sf_dir), ROLLING_BATCHES // 2))


def batch_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(fx.batch_metadata(store.sensor_data(spark, sf_dir)))


# --- compositions ------------------------------------------------------------

def _kpi_stats(apply: Callable[[DataFrame], DataFrame]) -> Query:
    return _kpi(lambda rows, as_of: apply(kpi.latency_stats(rows, as_of)), relative=True)


def _hourly(measure: str) -> Query:
    return _sensor(lambda df: readings.hourly_sensor_average(df, measure))


def kpi_bands(rows: DataFrame) -> DataFrame:
    total = kpi.of_metrics(rows, ["total_pipeline_latency"]).select("time", "value_ms")
    return monitoring.latency_bands(total, "value_ms")


def alert_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = msg.dead_letters(_parsed(spark, sf_dir))
    rows = store.sensor_data(spark, sf_dir)
    return monitoring.error_alert(rows, dead.withColumn("kafka_timestamp", instant_to_ntz("kafka_timestamp")))


# --- rollups -----------------------------------------------------------------

def long_range(spark: SparkSession, sf_dir: str) -> dict[str, dt.datetime]:
    """Bounds inside the long series that lie on no minute: its first and last hours are left out."""
    newest = latest_time(store.long_series(spark, sf_dir))
    return {"start": START + dt.timedelta(hours=3, minutes=17, seconds=23.456), "end": newest - dt.timedelta(hours=1, seconds=7.5)}


def rollup_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, rows = store.sensor_rollup(spark, sf_dir), store.long_series(spark, sf_dir)
    return shown(rollup.summary(rows, **long_range(spark, sf_dir)))


def rollup_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, rows = store.sensor_rollup(spark, sf_dir), store.long_series(spark, sf_dir)
    return shown(rollup.summary(rows, **long_range(spark, sf_dir), width=readings.HOUR, by=["sensor_id"]))


def rollup_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, rows = store.sensor_rollup(spark, sf_dir), store.long_series(spark, sf_dir)
    quarter = dt.timedelta(minutes=15)
    found = rollup.summary(rows, **long_range(spark, sf_dir), width=quarter)
    return shown(found.select(F.col("time").alias("bucket"), "avg_temperature", "avg_humidity"))


def rollup_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole series, bounds open: no reading is read, only partials."""
    rollup, rows = store.sensor_rollup(spark, sf_dir), store.long_series(spark, sf_dir)
    return shown(rollup.summary(rows, width=dt.timedelta(days=1), by=["sensor_id"]))


def rollup_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency evolution per minute from partials of the stage latencies."""
    rollup, rows = store.latency_rollup(spark, sf_dir), store.long_latency(spark, sf_dir)
    found = rollup.summary(rows, **long_range(spark, sf_dir), width=readings.MINUTE)
    return shown(found.select(F.col("time").alias("minute"), *[F.col(f"avg_{c}").alias(c) for c in latency.STAGE_COLUMNS]), 4)


# --- windows over a range of several days ------------------------------------

def rate_of_change_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, bounds = store.long_series(spark, sf_dir), long_range(spark, sf_dir)
    return shown(series.rate_of_change(rows, tie_break=TIE, stored_order=True, **bounds), 9)


def anomalies_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, bounds = store.long_series(spark, sf_dir), long_range(spark, sf_dir)
    return shown(series.anomalies(rows, tie_break=TIE, stored_order=True, **bounds).drop("event_id"))


# --- SQL names ---------------------------------------------------------------

def _moment_text(moment: dt.datetime) -> str:
    return f"TIMESTAMP_NTZ'{moment.isoformat(sep=' ')}'"


def _register(spark: SparkSession, sf_dir: str) -> None:
    register_views(spark, store.sensor_data_path(spark, sf_dir), store.pipeline_kpi_path(spark, sf_dir))


def sql_kpi_calculation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL table function over the whole series."""
    _register(spark, sf_dir)
    rows = spark.sql("SELECT * FROM calculate_pipeline_kpis(INTERVAL '36500' DAY, TIMESTAMP'2100-01-01 00:00:00')")
    return shown(rows.withColumn("time", F.col("time").cast("timestamp_ntz")), 4)


def sql_kpi_calculation_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL table function counted back from the middle of the series."""
    _register(spark, sf_dir)
    moment = _moment_text(middle_time(spark, sf_dir))
    rows = spark.sql(f"SELECT * FROM calculate_pipeline_kpis(INTERVAL '3' MINUTE, {moment})")
    return shown(rows.withColumn("time", F.col("time").cast("timestamp_ntz")), 4)


def _sql_latency_stats(moment: Callable, interval: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _register(spark, sf_dir)
        return shown(spark.sql(f"SELECT * FROM get_pipeline_latency_stats({interval}, {_moment_text(moment(spark, sf_dir))})"))

    return run


def newest_time(spark: SparkSession, sf_dir: str) -> dt.datetime:
    return latest_time(store.sensor_data(spark, sf_dir))


def sql_minute_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view of statistics per metric and minute."""
    _register(spark, sf_dir)
    return shown(spark.table("pipeline_kpi_stats"), 8)


def sql_time_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(spark, store.sensor_data(spark, sf_dir))
    return shown(
        spark.sql(
            "SELECT CAST(time_bucket('1 hour', time) AS TIMESTAMP_NTZ) AS hour, avg(temperature) AS avg_temperature, "
            "avg(humidity) AS avg_humidity FROM sensor_data GROUP BY ALL"
        )
    )


# --- streams -----------------------------------------------------------------

def stream_config(spark: SparkSession) -> IngestConfig:
    folder = scratch_path(spark, "stream")
    return IngestConfig(table_root=f"{folder}/tables", checkpoint_root=f"{folder}/checkpoints")


def _run_stream(spark: SparkSession, sf_dir: str, make_writer: Callable) -> IngestConfig:
    """Runs the stream until all of ``events`` is processed."""
    config = stream_config(spark)
    records = fx.bridged_messages(fx.events_stream(spark, sf_dir))
    parsed = ingest.parsed_stream(records, config)
    ingest.triggered(make_writer(parsed, config), config, drain=True).start().awaitTermination()
    return config


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _run_stream(spark, sf_dir, ingest.readings_writer)
    rows = spark.read.parquet(config.table("readings"))
    return shown(rows.select("time", "sensor_id", "temperature", "humidity"))


def stream_parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _run_stream(spark, sf_dir, ingest.archive_writer)
    rows = spark.read.parquet(config.table("archive"))
    return shown(rows.select("temperature", "humidity", "timestamp", "kafka_offset"))


def stream_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    def writer(parsed, config):
        return ingest.readings_writer(parsed, config, "extremes", extremes=True)

    config = _run_stream(spark, sf_dir, writer)
    return shown(spark.read.parquet(config.table("extremes")).select("time", "sensor_id", "temperature", "humidity"))


def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and checksums of the reading and dead-letter tables after one fan-out."""
    config = _run_stream(spark, sf_dir, fanout.fanout_writer)

    def summary(table: str, checked: str) -> DataFrame:
        rows = fanout.read_output(spark, config, table)
        return rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(checked).alias("offset_sum")).select(
            F.lit(table).alias("table_name"), "rows", "offset_sum"
        )

    return summary(fanout.READINGS, "kafka_offset").unionByName(summary(fanout.DEAD_LETTERS, "kafka_offset"))


def stream_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages counted by each metric over all micro-batches."""
    config = _run_stream(spark, sf_dir, fanout.fanout_writer)
    rows = fanout.read_output(spark, config, fanout.KPI)
    return rows.groupBy("metric_name").agg(F.sum("message_count").alias("message_count"))


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    def writer(parsed, config):
        return aggregates.tumbling_writer(ingest.reading_stream(parsed, config), config)

    return shown(aggregates.read_tumbling(spark, _run_stream(spark, sf_dir, writer)))


def stream_hourly_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    def writer(parsed, config):
        return aggregates.hourly_writer(ingest.reading_stream(parsed, config), config)

    return shown(aggregates.read_hourly(spark, _run_stream(spark, sf_dir, writer)))


def stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly summaries from the partials a stream keeps; the bounds are open, so no reading is read."""

    def writer(parsed, config):
        return aggregates.rollup_writer(ingest.reading_stream(parsed, config), config, merge_every=1)

    rollup = aggregates.stream_rollup(_run_stream(spark, sf_dir, writer))
    hourly = rollup.summary(rollup.read(spark, "hour"), width=readings.HOUR, by=["sensor_id"])
    return shown(hourly.withColumnRenamed("time", "hour"))


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input rows reported by the stream's own progress table."""
    config = stream_config(spark)
    listener = ProgressTable(spark, config.table("stream_progress"))
    spark.streams.addListener(listener)
    try:
        parsed = ingest.parsed_stream(fx.bridged_messages(fx.events_stream(spark, sf_dir)), config)
        query = ingest.triggered(ingest.archive_writer(parsed, config), config, drain=True).start()
        query.awaitTermination()
        if not listener.wait_for(query):
            raise TimeoutError("the stream's last progress reports were not stored in time")
    finally:
        spark.streams.removeListener(listener)
    rows = listener.read()
    return rows.groupBy("query_name").agg(F.sum("num_input_rows").alias("num_input_rows"))


# --- tables of the ingest job --------------------------------------------------

def stream_job_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and offset sums of the tables that one query over the topic fills, restarts included."""
    config = store.intake(spark, sf_dir)

    def summary(table: str) -> DataFrame:
        found = intake.read_intake(spark, config, table).agg(F.count(F.lit(1)).alias("rows"), F.sum("kafka_offset").alias("offset_sum"))
        return found.select(F.lit(table).alias("table_name"), "rows", "offset_sum")

    return reduce(DataFrame.unionByName, map(summary, (fanout.READINGS, intake.ARCHIVE, fanout.DEAD_LETTERS, intake.LATE)))


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per batch, late readings by the stored watermark among them."""
    rows = intake.read_intake(spark, store.intake(spark, sf_dir), intake.BATCHES)
    return shown(rows.select("batch_id", "newest", "message_count", "dead_count", "late_count"))


def stream_minute_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(intake.minute_windows(spark, store.intake(spark, sf_dir)))


def stream_kpi_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per batch what its KPI rows say about the stamps and values of its messages."""
    rows = intake.read_intake(spark, store.intake(spark, sf_dir), fanout.KPI)
    means = F.from_json("metadata", "avg_temperature double, avg_humidity double")

    def of(metric: str, value: Column) -> Column:
        return F.max(F.when(F.col("metric_name") == metric, value))

    return shown(
        rows.groupBy("batch_id").agg(
            F.max("message_count").alias("message_count"),
            F.count(F.lit(1)).alias("metrics"),
            of(MQTT_TO_KAFKA, F.col("value_ms")).alias("mqtt_to_kafka_ms"),
            of(SPARK_TO_STORE, means["avg_temperature"]).alias("avg_temperature"),
            of(SPARK_TO_STORE, means["avg_humidity"]).alias("avg_humidity"),
        ),
        4,
    )


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the alert states that the job kept over its batches and restarts."""
    rows = alerts.read_changes(spark, store.intake(spark, sf_dir))
    return shown(rows.select("rule", "minute", "state", "value"))


def compacted_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of the second day from merged day files and fresh batches; no other day is opened."""
    rows = intake.read_intake(spark, store.intake(spark, sf_dir), fanout.READINGS)
    day = rows.where(F.col("date") == F.lit(START.date() + dt.timedelta(days=1)))
    return shown(day.select("time", "sensor_id", "temperature", "humidity", "kafka_offset", "batch_id"))


def kpi_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store.batched_kpi(spark, sf_dir)
    found = rows.groupBy("date", "metric_name").agg(F.count(F.lit(1)).alias("n"), F.avg("value_ms").alias("avg_ms"), F.max("value_ms").alias("max_ms"))
    return shown(found)


def retention_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per day after the days before the last seven were deleted."""
    rows = store.kept_days(spark, sf_dir, 7)
    return shown(rows.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("number_sum"), F.min("time").alias("first")))


def registry() -> dict[str, Query]:
    ranged = {"start": START, "end": END}
    return {
        # sources, sinks, messages
        "parse_readings": parse_readings,
        "parse_base64_readings": parse_base64_readings,
        "dead_letter_split": dead_letter_split,
        "enrich_readings": enrich_readings,
        "raw_json": raw_json,
        "raw_map": raw_map,
        "sensor_range_scan": _sensor(readings.range_scan, **ranged),
        "retention_keep": retention_keep,
        "table_size": table_size,
        "kpi_emission": kpi_emission,
        "processing_metrics": processing_metrics,
        "batch_metadata": batch_metadata,
        # scans, filters, newest rows
        "sensor_last_hour": _sensor(readings.last_hour, relative=True),
        "extreme_values": _sensor(readings.extreme_values, **ranged),
        "extreme_values_all": _sensor(readings.extreme_values, n=None, **ranged),
        "integrity_violations": _sensor(readings.integrity_violations, relative=True),
        "integrity_violations_all": _sensor(readings.integrity_violations, window=None),
        "latest_reading": _sensor(readings.latest_reading),
        "latest_readings": _sensor(readings.latest_readings, relative=True),
        # aggregates
        "period_stats": _sensor(readings.period_stats, **ranged),
        "hourly_avg": _sensor(readings.hourly_average, **ranged),
        "hourly_avg_temperature": _hourly("temperature"),
        "hourly_avg_humidity": _hourly("humidity"),
        "hourly_sensor_summary": _sensor(readings.hourly_sensor_summary, relative=True),
        "trend_15m": _sensor(readings.trend, relative=True),
        "total_measurements": _sensor(readings.total_measurements, **ranged),
        "recent_count": _sensor(readings.recent_count, relative=True),
        "recent_count_asof": _sensor(readings.recent_count, relative=True, middle=True),
        "hourly_summary_asof": _sensor(readings.hourly_sensor_summary, relative=True, middle=True),
        "latest_readings_asof": _sensor(readings.latest_readings, relative=True, middle=True),
        "latency_stats_kpi_asof": _kpi(kpi.latency_stats, relative=True, middle=True),
        "readings_per_minute": _sensor(readings.readings_per_minute, relative=True),
        "ingestion_rate": _sensor(readings.ingestion_rate, relative=True),
        "throughput_30s": _sensor(readings.throughput_30s, relative=True),
        "throughput_1m": _sensor(readings.throughput_1m, **ranged),
        "hourly_volume": _sensor(readings.hourly_volume, relative=True),
        "recent_variation": _sensor(readings.recent_variation, relative=True),
        "write_latency": _sensor(readings.write_latency, relative=True),
        "temperature_counts": _sensor(histograms.temperature_counts, relative=True),
        # histograms and heat maps
        "heatmap_unit": _sensor(histograms.unit_heatmap, **ranged),
        "hist_temperature": _sensor(histograms.temperature_histogram, **ranged),
        "hist_humidity": _sensor(histograms.humidity_histogram, **ranged),
        "hist_temperature_all": _sensor(histograms.temperature_histogram, n=None, **ranged),
        "hist_humidity_all": _sensor(histograms.humidity_histogram, n=None, **ranged),
        "hist_2d": _sensor(histograms.joint_histogram, **ranged),
        "latency_histogram": _latency(histograms.latency_histogram, relative=True),
        # windows
        "rate_of_change": _sensor(series.rate_of_change, tie_break=TIE, stored_order=True),
        "rate_of_change_global": _sensor(series.rate_of_change, keys=(), tie_break=TIE, stored_order=True),
        "rate_of_change_range": rate_of_change_range,
        "anomalies": _sensor(lambda df: series.anomalies(df, tie_break=TIE, stored_order=True).drop("event_id")),
        "anomalies_hot_sensor": _sensor(
            lambda df: series.anomalies(df, tie_break=TIE, block_rows=2000).drop("event_id")
        ),
        "anomalies_global": _sensor(
            lambda df: series.anomalies(df, keys=(), tie_break=TIE, stored_order=True).drop("event_id")
        ),
        "anomalies_range": anomalies_range,
        "anomalies_top10": _sensor(
            lambda df: series.newest_anomalies(df, tie_break=TIE, stored_order=True).drop("event_id")
        ),
        "processing_series": _on(store.processing_metrics, latency.processing_series, **ranged),
        # stage latency
        "stage_latency": _latency(lambda df: df.drop("date")),
        "latency_stats_wide": _latency(latency.latency_stats_wide, relative=True),
        "latency_stats_wide_all": _latency(
            latency.latency_stats_wide, relative=True, window=dt.timedelta(days=36500)
        ),
        "kpi_calculation_10s": _on(store.sensor_data, latency.kpi_calculation, places=4, window=None),
        "latency_e2e_30s": _latency(latency.end_to_end_latency, relative=True),
        "latency_evolution": _latency(latency.latency_evolution, **ranged),
        "processing_time_30s": _on(store.processing_metrics, latency.processing_time_30s, relative=True),
        # batch metrics
        "latency_stats_kpi": _kpi(kpi.latency_stats, relative=True),
        "latency_stats_kpi_10m": _kpi(kpi.latency_stats, relative=True, window=dt.timedelta(minutes=10)),
        "latency_stats_kpi_1h": _kpi(kpi.latency_stats, relative=True, window=dt.timedelta(hours=1)),
        "latency_stats_ordered": _kpi_stats(latency.ordered_stats),
        "stage_avg": _kpi_stats(latency.stage_averages),
        "total_avg": _kpi_stats(latency.total_average),
        "kpi_minute_stats": _on(store.pipeline_kpi, kpi.minute_stats, places=8),
        "kpi_total_avg": _kpi(kpi.total_mean, relative=True),
        "kpi_total_p95": _kpi(kpi.total_p95, relative=True),
        "kpi_stage_share": _kpi(kpi.stage_share, relative=True),
        "kpi_message_volume": _kpi(kpi.message_volume, relative=True),
        "kpi_heatmap": _kpi(kpi.latency_heatmap, relative=True),
        "kpi_row_count": _kpi(kpi.row_count),
        "kpi_series": _kpi(kpi.series, relative=True),
        "kpi_series_wide": _kpi(kpi.series_wide, relative=True),
        "latest_kpi": _kpi(kpi.latest_rows),
        # monitoring
        "series_reducers": _kpi(lambda df: monitoring.series_reducers(df, key="metric_name")),
        "latency_bands": _kpi(kpi_bands),
        "alert_latency": _kpi(monitoring.latency_alert, relative=True, threshold_ms=500.0),
        "alert_throughput": _sensor(lambda df: monitoring.throughput_alert(fx.with_gaps(df), START, threshold=100)),
        "alert_errors": alert_errors,
        # rollups
        "rollup_range": rollup_range,
        "rollup_hourly": rollup_hourly,
        "rollup_trend": rollup_trend,
        "rollup_daily": rollup_daily,
        "rollup_latency": rollup_latency,
        # SQL names
        "sql_kpi_calculation": sql_kpi_calculation,
        "sql_kpi_calculation_asof": sql_kpi_calculation_asof,
        "sql_latency_stats": _sql_latency_stats(newest_time, "INTERVAL '2' MINUTE"),
        "sql_latency_stats_asof": _sql_latency_stats(middle_time, "INTERVAL '10' MINUTE"),
        "sql_minute_stats": sql_minute_stats,
        "sql_time_bucket": sql_time_bucket,
        # streams
        "stream_ingest": stream_ingest,
        "stream_parquet_sink": stream_parquet_sink,
        "stream_fanout": stream_fanout,
        "stream_kpi": stream_kpi,
        "stream_tumbling": stream_tumbling,
        "stream_extremes": stream_extremes,
        "stream_progress": stream_progress,
        "stream_hourly_view": stream_hourly_view,
        "stream_rollup": stream_rollup,
        # tables of the ingest job
        "stream_job_all": stream_job_all,
        "stream_batches": stream_batches,
        "stream_minute_windows": stream_minute_windows,
        "stream_kpi_stamps": stream_kpi_stamps,
        "stream_alerts": stream_alerts,
        "compacted_readings": compacted_readings,
        "kpi_by_day": kpi_by_day,
        "retention_7d": retention_7d,
    }
