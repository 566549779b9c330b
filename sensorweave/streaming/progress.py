"""Progress of running streams as table rows."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = (
    "query_id string, run_id string, query_name string, batch_id long, progress_time string, "
    "num_input_rows long, input_rows_per_second double, processed_rows_per_second double, "
    "dropped_by_watermark long, batch_duration_ms long, durations_ms string"
)


def progress_row(progress: dict) -> tuple:
    """One table row from a progress report."""
    durations = progress.get("durationMs") or {}
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for op in progress.get("stateOperators", []))
    return (
        progress["id"],
        progress["runId"],
        progress.get("name"),
        progress["batchId"],
        progress["timestamp"],
        progress.get("numInputRows", 0),
        float(progress.get("inputRowsPerSecond") or 0.0),
        float(progress.get("processedRowsPerSecond") or 0.0),
        dropped,
        durations.get("triggerExecution"),
        json.dumps(durations),
    )


class ProgressTable(StreamingQueryListener):
    """Appends every progress report to a Parquet table."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = path
        self._ended: dict[str, threading.Event] = {}

    def _event(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(str(event.runId))

    def onQueryProgress(self, event) -> None:
        row = progress_row(json.loads(event.progress.json))
        self._spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("append").parquet(self._path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._event(str(event.runId)).set()

    def wait_for(self, query: StreamingQuery, timeout: float = 60.0) -> bool:
        """Waits until all reports of an ended query are stored."""
        return self._event(str(query.runId)).wait(timeout)

    def read(self) -> DataFrame:
        return self._spark.read.schema(PROGRESS).parquet(self._path)
