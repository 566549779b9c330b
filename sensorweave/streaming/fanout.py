"""One read of the stream written to several tables, with per-batch metrics.

Every table is written by day and micro-batch id. Only the first batch after a start
can be a repeat; what an earlier attempt left of it, under any day, is deleted first.
Errors are raised: the query stops and the next start repeats the batch. Batches that
are complete can be merged into sorted day files (``compact_outputs``), and days that
are too old dropped (``expire_outputs``); ``read_output`` sees one table throughout.
"""

from __future__ import annotations

import datetime as dt
import time
from collections import deque
from collections.abc import Callable, Sequence
from functools import partial

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from sensorweave.config import IngestConfig
from sensorweave.functions.messages import dead_letters, enrich
from sensorweave.functions.timing import DATE, instant_to_ntz, with_date
from sensorweave.operators.kpi import emit_kpis, metadata_json
from sensorweave.operators.series import frame_statistics
from sensorweave.schemas import (
    KAFKA_TO_SPARK,
    MQTT_TO_KAFKA,
    PIPELINE_KPI,
    PROCESSING_METRICS,
    ROLLING_BATCHES,
    SENSOR_DATA,
    SPARK_TO_STORE,
)
from sensorweave.session import path_exists, run_together
from sensorweave.sources.tables import compact, create_table, drop_batch, drop_expired, overwrite_batch, read_table

READINGS = "sensor_data"
DEAD_LETTERS = "dead_letters"
KPI = "pipeline_kpi"
METRICS = "processing_metrics"

RowSink = Callable[[DataFrame, int], None]


COORDINATES = [T.StructField("kafka_partition", T.IntegerType()), T.StructField("kafka_offset", T.LongType())]
FIELDS = {
    READINGS: [*SENSOR_DATA.fields, *COORDINATES, T.StructField(DATE, T.DateType())],
    DEAD_LETTERS: [
        T.StructField("time", T.TimestampType()),
        T.StructField("kafka_key", T.BinaryType()),
        T.StructField("kafka_topic", T.StringType()),
        *COORDINATES,
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("message", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField(DATE, T.DateType()),
    ],
    KPI: [*PIPELINE_KPI.fields, T.StructField(DATE, T.DateType())],
    METRICS: [*PROCESSING_METRICS.fields, T.StructField(DATE, T.DateType())],
}


def merged(config: IngestConfig, table: str) -> str:
    """Where the day files of a table are."""
    return f"{config.table(table)}_days"


def _schema(fields: list[T.StructField]) -> T.StructType:
    kept = [field for field in fields if field.name != "batch_id"]
    return T.StructType(kept + [T.StructField("batch_id", T.LongType())])


def read_output(spark: SparkSession, config: IngestConfig, table: str, fields: list[T.StructField] | None = None) -> DataFrame:
    """One of the tables above, day files and batches not merged yet. The schema is given, so
    an empty table reads as such; filters on ``date`` open the folders of those days only."""
    schema = _schema(fields or FIELDS[table])
    fresh = read_table(spark, config.table(table), schema)
    days = merged(config, table)
    if not path_exists(spark, days):
        return fresh
    return fresh.unionByName(read_table(spark, days, schema))


def compact_outputs(spark: SparkSession, config: IngestConfig, tables: Sequence[str] = tuple(FIELDS)) -> None:
    """Merges the files of complete batches into day files. The newest batch stays, because a
    restarted stream may write it again. Call it where no batch is being written."""
    merges = [partial(compact, spark, config.table(table), merged(config, table), newest_stays=True, keep_batch=True) for table in tables]
    run_together(spark, merges)


def expire_outputs(
    spark: SparkSession, config: IngestConfig, as_of: dt.datetime, days: int = 30, tables: Sequence[str] = tuple(FIELDS)
) -> dict[str, list[dt.date]]:
    """Deletes the days of every table that end before the limit, and says which. A batch repeated
    afterwards may bring rows of such a day back; the next call deletes them."""
    found = {}
    for table in tables:
        paths = [path for path in (config.table(table), merged(config, table)) if path_exists(spark, path)]
        found[table] = sorted({day for path in paths for day in drop_expired(spark, path, as_of, days)})
    return found


class FanOut:
    """``foreachBatch`` callback over a parsed stream."""

    tables = (READINGS, DEAD_LETTERS, KPI, METRICS)

    def __init__(self, config: IngestConfig, row_sinks: tuple[RowSink, ...] = ()):
        self._config = config
        self._row_sinks = row_sinks
        self._may_repeat = True
        # Times of the last batches: at most ROLLING_BATCHES numbers, however long the stream runs.
        self._recent: deque[float] | None = None

    def __call__(self, parsed: DataFrame, batch_id: int) -> None:
        started, spark = time.time(), parsed.sparkSession
        if self._may_repeat:
            for table in self.tables:
                create_table(spark, self._config.table(table), T.StructType(self.fields(table)))
                drop_batch(spark, self._config.table(table), batch_id)
        # All sinks below read the batch; without this each would parse it again.
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = with_date(enrich(parsed, F.lit(started), self._config.default_sensor_id))
            summary = self._summary(rows)
            writes = [partial(self.store, dead_rows(parsed), DEAD_LETTERS, batch_id)]
            if summary["message_count"] > 0:
                writes += self.row_writes(parsed, rows, batch_id)
            run_together(spark, writes)
            if summary["message_count"] > 0:
                for sink in self._row_sinks:
                    sink(rows.drop(DATE), batch_id)
            self._store_metrics(spark, batch_id, summary, time.time() - started)
            self.commit(parsed, summary, batch_id)
        finally:
            parsed.unpersist()
        self._may_repeat = False

    @staticmethod
    def fields(table: str) -> list[T.StructField]:
        return FIELDS[table]

    def store(self, rows: DataFrame, table: str, batch_id: int) -> None:
        overwrite_batch(with_date(rows), self._config.table(table), batch_id, DATE)

    def row_writes(self, parsed: DataFrame, rows: DataFrame, batch_id: int) -> list[Callable[[], None]]:
        """What stores the readings of a batch that has some. The tables are written at the same time."""
        return [partial(self.store, rows, READINGS, batch_id)]

    def commit(self, parsed: DataFrame, summary: Row, batch_id: int) -> None:
        """Called last, when everything else of the batch is stored."""

    @staticmethod
    def _summary(rows: DataFrame) -> Row:
        """Count, newest time and means of the batch, as one row."""
        return rows.agg(
            F.count(F.lit(1)).alias("message_count"),
            instant_to_ntz(F.max("time")).alias("newest"),
            F.avg((F.col("kafka_send_time") - F.col("mqtt_receive_time")) * 1000).alias(MQTT_TO_KAFKA),
            F.avg((F.col("spark_receive_time") - F.col("kafka_send_time")) * 1000).alias(KAFKA_TO_SPARK),
            F.avg("temperature").alias("temperature"),
            F.avg("humidity").alias("humidity"),
        ).first()

    def _store_metrics(self, spark: SparkSession, batch_id: int, summary, seconds: float) -> None:
        now = F.current_timestamp().alias("time")

        def value(name: str):
            return F.lit(summary[name]).cast("double")

        stamp = (F.unix_micros(F.current_timestamp()) / F.lit(1e6)).alias("timestamp")
        batch = spark.range(0, 1, 1, 1).select(
            now,
            F.lit(str(batch_id)).alias("batch_id"),
            F.lit(summary["message_count"]).alias("message_count"),
            value(MQTT_TO_KAFKA).alias(MQTT_TO_KAFKA),
            value(KAFKA_TO_SPARK).alias(KAFKA_TO_SPARK),
            F.lit(seconds * 1000).alias(SPARK_TO_STORE),
            metadata_json(value("temperature"), value("humidity"), stamp).alias("metadata"),
        )
        self.store(emit_kpis(batch), KPI, batch_id)
        if self._recent is None:
            self._recent = self._stored_times(spark, batch_id)
        self._recent.append(seconds)
        self.store(self._metrics_row(spark, seconds), METRICS, batch_id)

    def _stored_times(self, spark: SparkSession, batch_id: int) -> deque[float]:
        """Times before a restart, from the batch folders of the last window only."""
        times: deque[float] = deque(maxlen=ROLLING_BATCHES)
        if batch_id > 0:
            window = F.col("batch_id").between(batch_id - ROLLING_BATCHES + 1, batch_id - 1)
            earlier = read_output(spark, self._config, METRICS).where(window)
            rows = earlier.orderBy("batch_id").select("processing_time").collect()
            times.extend(row[0] for row in rows)
        return times

    def _metrics_row(self, spark: SparkSession, seconds: float) -> DataFrame:
        """The batch time with the statistics of the last batches."""
        recent = np.array(self._recent)
        found, counts = frame_statistics(ROLLING_BATCHES)(recent, np.ones(len(recent), dtype=bool))
        values = {"processing_time": seconds} | {
            f"{name}_processing_time": float(found[name][-1]) for name in ("avg", "min", "max", "stddev", "median")
        }
        return spark.range(0, 1, 1, 1).select(
            F.current_timestamp().alias("time"),
            *[F.lit(value).alias(name) for name, value in values.items()],
            F.lit(int(counts[-1])).alias("sample_size"),
        )


def dead_rows(parsed: DataFrame) -> DataFrame:
    """Malformed messages at their arrival, or at the time they were read where that is unknown."""
    arrival = F.coalesce("kafka_timestamp", F.current_timestamp())
    return dead_letters(parsed).select(arrival.alias("time"), "*")


def fanout_writer(parsed: DataFrame, config: IngestConfig, row_sinks: tuple[RowSink, ...] = ()) -> DataStreamWriter:
    return (
        parsed.writeStream.queryName("fanout")
        .outputMode("append")
        .option("checkpointLocation", config.checkpoint("fanout"))
        .foreachBatch(FanOut(config, row_sinks))
    )
