"""Parquet tables partitioned by day: write, read, keep, measure.

A time-series table here has one folder per UTC day; inside a day the files
cover narrow time ranges, so a time filter skips days by folder and files by
their minimum and maximum.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.functions.timing import DATE, resolve_as_of, time_filter, with_date
from sensorweave.session import delete_path, delete_paths, list_folders, match_paths, path_exists


def create_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Creates an empty day-partitioned table unless ``path`` already holds one."""
    if DATE not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(DATE, T.DateType())])
    spark.createDataFrame([], schema).write.partitionBy(DATE).mode("ignore").parquet(path)


def append(df: DataFrame, path: str, *partitions: str) -> None:
    """Appends without a shuffle; every task adds files to the days it holds."""
    with_date(df).write.mode("append").partitionBy(DATE, *partitions).parquet(path)


Dated = Callable[[DataFrame], DataFrame]


def write_sorted(
    df: DataFrame, path: str, mode: str = "errorifexists", order: tuple[str, ...] = ("time",), dated: Dated = with_date
) -> None:
    """Writes ranges of time per file, sorted. ``dated`` adds the day that names a row's folder.

    Ranges are cut by row count, so a busy day spreads over many tasks; the row
    hash lets even one busy instant be cut.
    """
    ordered = dated(df).repartitionByRange(DATE, *order, F.xxhash64(*df.columns)).sortWithinPartitions(DATE, *order)
    ordered.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(path)


def overwrite_batch(df: DataFrame, path: str, batch_id: int, *partitions: str, order: tuple[str, ...] = ()) -> None:
    """Writes the rows of one micro-batch in place of an earlier attempt at it. Without a day in
    ``partitions`` the files may be ranges of ``order``."""
    tagged = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
    if DATE in partitions:
        # Ranges of days, cut by row count: about one file per day, where every task would else add
        # one to every day of its rows. The row hash lets even one busy day be cut.
        tagged = tagged.repartitionByRange(DATE, F.xxhash64(*df.columns))
    elif order:
        tagged = tagged.repartitionByRange(*order).sortWithinPartitions("batch_id", *order)
    writer = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions, "batch_id").parquet(path)


def drop_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Deletes what an earlier attempt at a micro-batch left, below any day or beside the days."""
    patterns = (f"{path}/batch_id={batch_id}", f"{path}/{DATE}=*/batch_id={batch_id}")
    delete_paths(spark, [folder for pattern in patterns for folder in match_paths(spark, pattern)])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


# --- compaction --------------------------------------------------------------

STAGING = "_staging"
STAGED_BATCHES = "_staging_batches"


def batch_folders(spark: SparkSession, source: str) -> dict[int, list[str]]:
    """Folders of each micro-batch, directly below ``source`` or below its days."""
    found: dict[int, list[str]] = {}
    for pattern in (f"{source}/batch_id=*", f"{source}/{DATE}=*/batch_id=*"):
        for folder in match_paths(spark, pattern):
            found.setdefault(int(folder.rsplit("batch_id=", 1)[1]), []).append(folder)
    return found


def _staged_batches(spark: SparkSession, target: str) -> list[int]:
    """Batches of a staging copy that is complete; its list is written last."""
    path = f"{target}/{STAGED_BATCHES}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return []
    return [row[0] for row in spark.read.schema("batch_id long").parquet(path).collect()]


def _finish(spark: SparkSession, source: str, target: str, batches: list[int], order: tuple[str, ...], dated: Dated) -> None:
    staged = spark.read.parquet(f"{target}/{STAGING}")
    write_sorted(staged.drop(DATE), target, "overwrite", order, dated)
    folders = batch_folders(spark, source)
    delete_paths(spark, [folder for batch in batches for folder in folders.get(batch, [])])
    delete_path(spark, f"{target}/{STAGED_BATCHES}")
    delete_path(spark, f"{target}/{STAGING}")


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    order: tuple[str, ...] = ("time",),
    combine: Callable[[DataFrame], DataFrame] | None = None,
    newest_stays: bool = False,
    keep_batch: bool = False,
    dated: Dated = with_date,
) -> None:
    """Moves the rows of the per-batch files of ``source`` into the sorted day table ``target``.

    The touched days, old rows and new ones, are first written as a staging copy with
    the list of its batches. Then the copy replaces these days, and only then are the
    batches deleted. A run that was cut off before the list was complete has changed
    nothing; after that, the next run finishes it first. So no row is lost or doubled.
    Batches that arrive meanwhile wait for the next run. ``combine`` merges rows of the
    touched days, such as partial sums; ``newest_stays`` leaves out the newest batch, the
    one that a restarted stream writes again; ``keep_batch`` keeps the batch ids as a column;
    ``dated`` adds the day that names a row's folder.
    """
    pending = _staged_batches(spark, target)
    if pending:
        _finish(spark, source, target, pending, order, dated)
    batches = sorted(batch_folders(spark, source))
    if newest_stays:
        batches = batches[:-1]
    if not batches:
        return
    for left in (STAGED_BATCHES, STAGING):
        delete_path(spark, f"{target}/{left}")
    new = spark.read.parquet(source).where(F.col("batch_id").isin(batches)).withColumn("batch_id", F.col("batch_id").cast("long"))
    new = dated(new.drop(DATE, *([] if keep_batch else ["batch_id"])))
    if path_exists(spark, target) and stored_days(spark, target):
        touched = [row[0] for row in new.select(DATE).distinct().collect()]  # one row per day
        old = spark.read.parquet(target).where(F.col(DATE).isin(touched))
        new = new.unionByName(old, allowMissingColumns=True)
    if combine is not None:
        new = dated(combine(new.drop(DATE)))
    new.write.parquet(f"{target}/{STAGING}")
    spark.createDataFrame([(b,) for b in batches], "batch_id long").coalesce(1).write.parquet(f"{target}/{STAGED_BATCHES}")
    _finish(spark, source, target, batches, order, dated)


def read_compacted(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rows of ``target`` and of the batches of ``source`` that are not in it yet."""
    parts = []
    if path_exists(spark, target) and stored_days(spark, target):
        parts.append(spark.read.parquet(target))
    if batch_folders(spark, source):
        parts.append(with_date(spark.read.parquet(source).drop("batch_id", DATE)))
    if not parts:
        raise FileNotFoundError(f"neither {source} nor {target} holds rows")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


# --- retention ---------------------------------------------------------------

def retained(df: DataFrame, days: int = 30, as_of: dt.datetime | None = None) -> DataFrame:
    """Rows of the last ``days`` days."""
    return time_filter(df, start=resolve_as_of(df, as_of) - dt.timedelta(days=days))


def stored_days(spark: SparkSession, path: str) -> list[dt.date]:
    """Days of a stored table, from its folder names."""
    prefix = f"{DATE}="
    names = [name for name in list_folders(spark, path) if name.startswith(prefix)]
    days = (name.removeprefix(prefix) for name in names)
    return sorted(dt.date.fromisoformat(day) for day in days if day[:1].isdigit())  # rows without a time have no day


def drop_expired(spark: SparkSession, path: str, as_of: dt.datetime, days: int = 30) -> list[dt.date]:
    """Deletes the day folders that end before the retention limit and returns their dates."""
    limit = (as_of - dt.timedelta(days=days)).date()
    expired = [day for day in stored_days(spark, path) if day < limit]
    delete_paths(spark, [f"{path}/{DATE}={day.isoformat()}" for day in expired])
    return expired


# --- size --------------------------------------------------------------------

# Size units, each 1024 times the one before.
SIZE_UNITS = ("bytes", "kB", "MB", "GB", "TB", "PB")


def pretty_size(size: Column) -> Column:
    """Whole number in the largest unit that keeps it below 10240."""
    text = None
    for power in range(len(SIZE_UNITS) - 1, -1, -1):
        shown = F.concat(F.round(size / F.lit(1024.0**power)).cast("long").cast("string"), F.lit(f" {SIZE_UNITS[power]}"))
        if text is None:
            text = shown
        else:
            text = F.when(size < F.lit(10240.0 * 1024.0**power), shown).otherwise(text)
    return text


def table_size(spark: SparkSession, path: str) -> DataFrame:
    """Bytes and files of a stored table: one listed row per file, no content read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("length")
    )
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"), F.count(F.lit(1)).alias("files"))
    return total.withColumn("total_table_size", pretty_size(F.col("total_bytes")))
