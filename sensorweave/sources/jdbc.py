"""JDBC tables: scan, append, and replay-safe append of a micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_KEY = ("kafka_partition", "kafka_offset")


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Scan of a table; with a partition column, in that many parallel ranges."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()


def append(df: DataFrame, options: Mapping[str, str], table: str) -> None:
    """Appends; the ``numPartitions`` option bounds the connections in use."""
    df.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()


def missing_rows(batch: DataFrame, stored: DataFrame, key: Sequence[str] = MESSAGE_KEY) -> DataFrame:
    """Rows of a batch whose message is not stored yet."""
    return batch.join(stored.select(*key).distinct(), list(key), "left_anti")


class ReplaySafeAppend:
    """Appends each micro-batch once, also when a restart repeats one.

    The target needs the message key columns and a text ``batch_id`` next to the
    readings. For a JSON-typed ``raw_data`` column on PostgreSQL pass the option
    ``stringtype=unspecified``.

    Only the first batch after a start can be a repeat, so only that one is
    compared with what an earlier attempt stored under its ``batch_id``.
    """

    def __init__(self, read: Callable[[int], DataFrame], write: Callable[[DataFrame], None]):
        self._read = read
        self._write = write
        self._may_repeat = True

    @classmethod
    def to_jdbc(cls, spark: SparkSession, options: Mapping[str, str], table: str) -> "ReplaySafeAppend":
        def stored(batch_id: int) -> DataFrame:
            return read_table(spark, options, table).where(F.col("batch_id") == F.lit(str(batch_id)))

        return cls(stored, lambda rows: append(rows, options, table))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(str(batch_id)))
        if self._may_repeat:
            rows = missing_rows(rows, self._read(batch_id))
        self._write(rows)
        self._may_repeat = False
