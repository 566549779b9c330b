"""The ingest job: one stream over the topic for all tables, and debug output, supervised together.

Usage: python -m sensorweave.streaming.job settings.json
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sensorweave.config import IngestConfig
from sensorweave.session import build_session
from sensorweave.sources.jdbc import ReplaySafeAppend
from sensorweave.sources.kafka import kafka_stream
from sensorweave.streaming.alerts import AlertBook
from sensorweave.streaming.fanout import READINGS
from sensorweave.streaming.ingest import console_writer, parsed_stream, triggered
from sensorweave.streaming.intake import intake_writer
from sensorweave.streaming.progress import ProgressTable


def start_streams(
    records: DataFrame, config: IngestConfig, drain: bool = False, alerts: AlertBook | None = None
) -> list[StreamingQuery]:
    """Starts the one query that reads the topic for all tables, and console output if asked for."""
    spark = records.sparkSession
    parsed = parsed_stream(records, config)
    sinks = (ReplaySafeAppend.to_jdbc(spark, config.jdbc, READINGS),) if config.jdbc else ()
    writers = [intake_writer(parsed, config, sinks, alerts=alerts)]
    if config.console:
        text = records.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
        writers.append(console_writer(text, "console_raw", config.checkpoint("console_raw")))
        writers.append(console_writer(parsed, "console_parsed", config.checkpoint("console_parsed")))
    return [triggered(writer, config, drain).start() for writer in writers]


def await_all(queries: list[StreamingQuery], poll_seconds: float = 1.0, on_poll: Callable[[], None] | None = None) -> None:
    """Returns when all queries ended; if one fails the others stop and it raises.

    ``on_poll`` is called between the polls, also while no message arrives.
    """

    def raise_failure() -> None:
        for query in queries:
            failure = query.exception()
            if failure is not None:
                raise failure

    try:
        while running := [query for query in queries if query.isActive]:
            raise_failure()
            running[0].awaitTermination(poll_seconds)
            if on_poll:
                on_poll()
        raise_failure()
    finally:
        for query in queries:
            query.stop()


def run(spark: SparkSession, config: IngestConfig) -> None:
    listener = ProgressTable(spark, config.table("stream_progress"))
    spark.streams.addListener(listener)
    try:
        alerts = AlertBook(config)
        await_all(start_streams(kafka_stream(spark, config), config, alerts=alerts), on_poll=lambda: alerts.tick(spark))
    finally:
        spark.streams.removeListener(listener)


def main(argv: list[str]) -> None:
    with open(argv[0], encoding="utf-8") as handle:
        settings = json.load(handle)
    spark = build_session("sensorweave-ingest", extra=settings.pop("spark", None))
    try:
        run(spark, IngestConfig.from_mapping(settings))
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
