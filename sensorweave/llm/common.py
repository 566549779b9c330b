"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import time
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.session import delete_path, scratch_path

#: Rows handled at once inside a task; bounds Python memory beside Arrow's own batch.
ROWS_AT_ONCE = 256


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, as --py-files would."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    name = os.path.join(tempfile.mkdtemp(prefix="sensorweave-code-"), "sensorweave-code.zip")
    with zipfile.ZipFile(name, "w") as archive:
        for folder, _, files in os.walk(os.path.join(top, "sensorweave")):
            for file in sorted(files):
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    archive.write(path, os.path.relpath(path, top))
    spark.sparkContext.addPyFile(name)
    _shipped.add(application)
    # Whole texts in batches of Spark's default of 10,000 rows take tens of megabytes,
    # several times over, in Python and beside the executor's heap.
    if int(spark.conf.get(ARROW_ROWS)) == 10_000:
        spark.conf.set(ARROW_ROWS, "2000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes() -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def whole_text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


#: What operators keep in a Python worker for its next tasks: name -> how to drop it.
_worker_caches: dict[str, Callable[[], None]] = {}


def kept_in_worker(name: str, drop: Callable[[], None]) -> None:
    _worker_caches[name] = drop


def hand_back_memory() -> None:
    """Returns freed pages to the system: a worker that lives on would hold what an earlier
    stage took at its peak."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        pass


def slices(
    batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE, keep: str | None = None
) -> Iterator[pa.RecordBatch]:
    """Batches in small pieces. What other operators left in this worker is dropped, so
    that memory does not add up over the stages of a pipeline."""
    for name, drop in _worker_caches.items():
        if name != keep:
            drop()
    hand_back_memory()
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id falls in fold 0."""
    return (F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(0)) % folds).cast("int")


def fold_of(doc_id: int | None, folds: int) -> int:
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def written(frame: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Writes a table to the shared scratch folder and reads it back, which cuts lineage."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        delete_path(spark, path)


def release_shuffles(spark: SparkSession) -> None:
    """Lets the driver notice that finished plans are out of use. Spark deletes their
    shuffle files only when the driver collects its garbage, by default every half hour."""
    for _ in range(2):  # the first pass frees plans, the second what they held
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1.5)  # the files go in the background
