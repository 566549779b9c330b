"""Stored tables the registered queries read, written once per application.

Readings, KPI rows and batch metrics are stored by day before they are
queried, as in production, so the queries scan columns, prune days and push
time filters into the files instead of deriving every value again.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.config import IngestConfig
from sensorweave.functions.timing import DATE, latest_time, with_date
from sensorweave.operators.latency import STAGE_COLUMNS, stage_latency
from sensorweave.operators.rollups import Rollup
from sensorweave.plans import fixtures as fx
from sensorweave.session import path_exists, scratch_path
from sensorweave.sources.kafka import record_stream
from sensorweave.sources.tables import compact, drop_expired, overwrite_batch, read_compacted, read_table, write_sorted
from sensorweave.streaming.alerts import ERRORS, THROUGHPUT, AlertBook, Rule
from sensorweave.streaming.ingest import parsed_stream, triggered
from sensorweave.streaming.intake import intake_writer

# Finished tables of this process: (application, source, name) -> (path, schema).
_finished: dict[tuple[str, str, str], tuple[str, T.StructType]] = {}
# Readings of one instant are told apart by their number.
READING_ORDER = ("time", "event_id")
_rollups: dict[tuple[str, str, str], Rollup] = {}
_lock = threading.RLock()


def _stored(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], order: tuple[str, ...] = ("time",)
) -> tuple[str, T.StructType]:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _lock:
        if key not in _finished or not path_exists(spark, _finished[key][0]):
            path = scratch_path(spark, name)
            write_sorted(build(), path, order=order)
            _finished[key] = (path, read_table(spark, path).schema)
        return _finished[key]


def _sensor_data(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    return _stored(spark, sf_dir, "sensor_data", lambda: fx.sensor_data(spark, sf_dir).drop("ep"), READING_ORDER)


def sensor_data_path(spark: SparkSession, sf_dir: str) -> str:
    return _sensor_data(spark, sf_dir)[0]


def sensor_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, *_sensor_data(spark, sf_dir))


def long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, *_stored(spark, sf_dir, "long_series", lambda: fx.long_series(spark, sf_dir).drop("ep"), READING_ORDER))


def _late() -> Column:
    """Late readings of the long series: they reach the rollups in a batch of their own."""
    return fx.is_late(F.col("event_id"))


def _rollup(spark: SparkSession, sf_dir: str, name: str, rows: Callable[[], DataFrame], **options) -> Rollup:
    """A rollup fed by two batches; the second one holds late rows and is written twice."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _lock:
        if key not in _rollups or not path_exists(spark, _rollups[key].root):
            rollup, source = Rollup(scratch_path(spark, name), **options), rows()
            for batch, part in enumerate([~_late(), _late(), _late()]):
                rollup.add(source.where(part), min(batch, 1))
            rollup.merge(spark)
            _rollups[key] = rollup
        return _rollups[key]


def long_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_latency(long_series(spark, sf_dir), kept=("event_id",))


def sensor_rollup(spark: SparkSession, sf_dir: str) -> Rollup:
    return _rollup(spark, sf_dir, "sensor_rollup", lambda: long_series(spark, sf_dir))


def latency_rollup(spark: SparkSession, sf_dir: str) -> Rollup:
    rows = partial(long_latency, spark, sf_dir)
    return _rollup(spark, sf_dir, "latency_rollup", rows, measures=STAGE_COLUMNS, keys=())


def _pipeline_kpi(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    return _stored(spark, sf_dir, "pipeline_kpi", lambda: fx.pipeline_kpi(sensor_data(spark, sf_dir)))


def pipeline_kpi_path(spark: SparkSession, sf_dir: str) -> str:
    return _pipeline_kpi(spark, sf_dir)[0]


def pipeline_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, *_pipeline_kpi(spark, sf_dir))


def processing_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, sf_dir, "processing_metrics", lambda: fx.processing_metrics(sensor_data(spark, sf_dir)))
    return read_table(spark, *stored)


#: Rules of the job below: two readings a minute are usual.
ALERT_RULES = (Rule(THROUGHPUT, 2, hold=2), Rule(ERRORS, 1, above=True))
_intakes: dict[tuple[str, str], IngestConfig] = {}


def intake(spark: SparkSession, sf_dir: str) -> IngestConfig:
    """Tables of the ingest job after three parts of a topic, restarted after each; the batches before
    the last two are merged."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _intakes or not path_exists(spark, _intakes[key].table_root):
            folder = scratch_path(spark, "intake")
            config = IngestConfig(table_root=f"{folder}/tables", checkpoint_root=f"{folder}/checkpoints")
            events = fx.events(spark, sf_dir)
            newest = events.agg(F.max("event_id")).first()[0] or 0
            for part in fx.message_parts(events, newest):
                part.write.mode("append").parquet(f"{folder}/topic")
                parsed = parsed_stream(record_stream(spark, f"{folder}/topic"), config)
                triggered(intake_writer(parsed, config, merge_every=2, alerts=AlertBook(config, ALERT_RULES)), config, drain=True).start().awaitTermination()
            _intakes[key] = config
        return _intakes[key]


def kept_days(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    """Readings two minutes apart after the days before the last ``days`` were dropped."""
    path = scratch_path(spark, "retention")
    write_sorted(fx.readings(fx.events(spark, sf_dir), 120_000).drop("ep"), path, order=READING_ORDER)
    drop_expired(spark, path, latest_time(read_table(spark, path)), days)
    return read_table(spark, path)


def batched_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPI rows of the long series in three batches by day: the first two merged, the last one written twice."""
    source, target = scratch_path(spark, "kpi_batches"), scratch_path(spark, "kpi_days")
    staged = scratch_path(spark, "kpi_rows")
    fx.pipeline_kpi(long_series(spark, sf_dir)).write.parquet(staged)
    rows = read_table(spark, staged)
    part = F.col("batch_id").cast("long") % 3
    for batch in (0, 1, 2, 2):
        overwrite_batch(with_date(rows.where(part == batch).drop("batch_id")), source, batch, DATE)
    compact(spark, source, target, newest_stays=True)
    return read_compacted(spark, source, target)
