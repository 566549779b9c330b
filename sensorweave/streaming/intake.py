"""The whole job as one query: one read of the topic feeds every table.

Each micro-batch adds, under its own id: readings, archive, dead letters, KPI rows, batch
metrics, the minute, hour and day partials that answer windows of any such width, and late
readings. A reading is late when its time lies before the watermark, which is the newest
time of all earlier batches less the allowed lateness. Late readings count in every table
and are listed in a table of their own besides.

The batch's row in the table of batches is written last. It holds the watermark for the next
batch, so that a restart goes on with the same one and a repeated batch judges alike.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from sensorweave.config import IngestConfig
from sensorweave.functions.messages import good_rows, instant
from sensorweave.functions.timing import DATE, time_literal
from sensorweave.session import run_together
from sensorweave.sources.tables import read_table
from sensorweave.streaming.aggregates import stream_rollup
from sensorweave.streaming.alerts import AlertBook
from sensorweave.streaming.fanout import FIELDS, READINGS, FanOut, RowSink, compact_outputs, expire_outputs, read_output

ARCHIVE = "archive"
LATE = "late_readings"
BATCHES = "batches"
INTAKE = "intake"

_DAY = T.StructField(DATE, T.DateType())
INTAKE_FIELDS = FIELDS | {
    LATE: FIELDS[READINGS],
    ARCHIVE: [
        T.StructField("time", T.TimestampType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        _DAY,
    ],
    BATCHES: [
        T.StructField("time", T.TimestampType()),
        T.StructField("newest", T.TimestampNTZType()),
        T.StructField("message_count", T.LongType()),
        T.StructField("dead_count", T.LongType()),
        T.StructField("late_count", T.LongType()),
        _DAY,
    ],
}


class Intake(FanOut):
    """``foreachBatch`` callback that keeps every table of the job."""

    tables = tuple(INTAKE_FIELDS)

    def __init__(
        self,
        config: IngestConfig,
        row_sinks: tuple[RowSink, ...] = (),
        lateness: dt.timedelta = dt.timedelta(minutes=10),
        merge_every: int = 100,
        alerts: AlertBook | None = None,
    ):
        super().__init__(config, row_sinks)
        self._alerts = alerts
        self._lateness, self._merge_every = lateness, merge_every
        self._rollup = stream_rollup(config)
        # Newest time of all batches before the running one; read from the last batch's row at the start.
        self._newest: dt.datetime | None = None
        self._late_count = 0

    @staticmethod
    def fields(table: str) -> list[T.StructField]:
        return INTAKE_FIELDS[table]

    def __call__(self, parsed: DataFrame, batch_id: int) -> None:
        spark = parsed.sparkSession
        if self._may_repeat:
            self._newest = self._stored_newest(spark, batch_id)
            self._rollup.forget(spark, batch_id)
        self._late_count = 0
        super().__call__(parsed, batch_id)
        if self._alerts and self._newest is not None:
            self._alerts.judge(spark, self._newest - self._lateness)
        if self._merge_every and batch_id % self._merge_every == self._merge_every - 1:
            compact_intake(spark, self._config)

    def _stored_newest(self, spark: SparkSession, batch_id: int) -> dt.datetime | None:
        if batch_id == 0:
            return None
        schema = T.StructType([*self.fields(BATCHES), T.StructField("batch_id", T.LongType())])
        # The batch before is never merged, so its folder alone is opened.
        row = read_table(spark, self._config.table(BATCHES), schema).where(F.col("batch_id") == batch_id - 1).first()
        return row["newest"] if row else None

    def row_writes(self, parsed: DataFrame, rows: DataFrame, batch_id: int) -> list[Callable[[], None]]:
        writes = super().row_writes(parsed, rows, batch_id)
        writes += [partial(self.store, archive_rows(parsed), ARCHIVE, batch_id), partial(self._rollup.add, rows, batch_id)]
        if self._newest is not None:
            late = rows.where(F.col("time") < time_literal(rows, self._newest - self._lateness))
            writes.append(partial(self._store_late, late, batch_id))
        return writes

    def _store_late(self, late: DataFrame, batch_id: int) -> None:
        self._late_count = late.count()  # of the persisted batch
        self.store(late, LATE, batch_id)

    def commit(self, parsed: DataFrame, summary: Row, batch_id: int) -> None:
        newest = max((t for t in (self._newest, summary["newest"]) if t is not None), default=None)
        row = parsed.sparkSession.range(0, 1, 1, 1).select(
            F.current_timestamp().alias("time"),
            F.lit(newest).cast("timestamp_ntz").alias("newest"),
            F.lit(summary["message_count"]).cast("long").alias("message_count"),
            F.lit(parsed.where(~F.col("is_valid")).count()).cast("long").alias("dead_count"),
            F.lit(self._late_count).cast("long").alias("late_count"),
        )
        self.store(row, BATCHES, batch_id)
        self._newest = newest


def archive_rows(parsed: DataFrame) -> DataFrame:
    """The message fields of valid messages."""
    rows = good_rows(parsed).withColumn("time", instant("timestamp"))
    return rows.select("time", "temperature", "humidity", "timestamp", "sensor_id", "kafka_partition", "kafka_offset")


def read_intake(spark: SparkSession, config: IngestConfig, table: str) -> DataFrame:
    return read_output(spark, config, table, INTAKE_FIELDS[table])


def minute_windows(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """Count and means per minute and sensor from the partials, late readings included."""
    rollup = stream_rollup(config)
    found = rollup.summary(rollup.read(spark, "minute"), width=dt.timedelta(minutes=1), by=["sensor_id"])
    return found.select(
        F.col("time").alias("window_start"), "sensor_id", F.col("n").alias("readings_count"), "avg_temperature", "avg_humidity"
    )


def compact_intake(spark: SparkSession, config: IngestConfig) -> None:
    """Merges the batches' files of all tables and partials. Call it where no batch is being written."""
    run_together(spark, [partial(compact_outputs, spark, config, tuple(INTAKE_FIELDS)), partial(stream_rollup(config).merge, spark)])


def expire_intake(spark: SparkSession, config: IngestConfig, as_of: dt.datetime, days: int = 30) -> dict[str, list[dt.date]]:
    return expire_outputs(spark, config, as_of, days, tuple(INTAKE_FIELDS))


def intake_writer(parsed: DataFrame, config: IngestConfig, row_sinks: tuple[RowSink, ...] = (), **options) -> DataStreamWriter:
    return (
        parsed.writeStream.queryName(INTAKE)
        .outputMode("append")
        .option("checkpointLocation", config.checkpoint(INTAKE))
        .foreachBatch(Intake(config, row_sinks, **options))
    )
