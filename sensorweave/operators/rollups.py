"""Rollups: mergeable partials per minute, hour and day, and ranges answered from them.

Every batch of readings adds its partial counts, sums, minima and maxima to three levels of
tables; a late reading is simply part of a later batch. A range with any bounds is then cut
into whole days, the whole hours left at both ends, the whole minutes left of these, and the
two remainders below a minute. Only the remainders are read from the readings themselves.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.functions.timing import DATE, EPOCH, time_bucket, time_literal, with_date
from sensorweave.session import path_exists, run_together
from sensorweave.sources.tables import batch_folders, compact, drop_batch, overwrite_batch, stored_days

DAY, HOUR, MINUTE = dt.timedelta(days=1), dt.timedelta(hours=1), dt.timedelta(minutes=1)
INSTANT = dt.timedelta(microseconds=1)
#: Levels from coarse to fine.
LEVELS = {"day": DAY, "hour": HOUR, "minute": MINUTE}
#: What a folder of merged buckets spans where that is more than a day. By day, the coarse levels of
#: a long series would be as many files as the finest one, of 1 or 24 buckets a key.
FOLDERS = {"day": "year", "hour": "month"}
RAW = "raw"
FIRST, LAST = dt.datetime(1000, 1, 1), dt.datetime(9999, 12, 31)

Piece = tuple[str, dt.datetime, dt.datetime]


def floor_to(value: dt.datetime, width: dt.timedelta) -> dt.datetime:
    return value - (value - EPOCH) % width


def ceil_to(value: dt.datetime, width: dt.timedelta) -> dt.datetime:
    return value + (EPOCH - value) % width


def cover(start: dt.datetime, end: dt.datetime, levels: Sequence[str]) -> list[Piece]:
    """``start <= time < end`` as whole buckets of the coarsest levels that fit, in order;
    what is left at the ends is of level ``RAW``. ``levels`` go from coarse to fine."""
    if start >= end:
        return []
    if not levels:
        return [(RAW, start, end)]
    width, finer = LEVELS[levels[0]], levels[1:]
    first, last = ceil_to(start, width), floor_to(end, width)
    if first >= last:
        return cover(start, end, finer)
    return [*cover(start, first, finer), (levels[0], first, last), *cover(last, end, finer)]


def levels_within(width: dt.timedelta | None) -> list[str]:
    """Levels whose buckets never cross a bucket of ``width``; all of them without a width."""
    return [name for name, step in LEVELS.items() if width is None or width % step == dt.timedelta(0)]


def in_folders(partials: DataFrame, level: str) -> DataFrame:
    """Adds the first UTC day of the folder that holds a bucket."""
    dated = with_date(partials)
    return dated.withColumn(DATE, F.trunc(DATE, FOLDERS[level])) if level in FOLDERS else dated


def _width_text(width: dt.timedelta) -> str:
    return f"{width // INSTANT} microseconds"


@dataclass(frozen=True)
class Rollup:
    """Partials of ``measures`` by ``keys``, stored below ``root``."""

    root: str
    measures: tuple[str, ...] = ("temperature", "humidity")
    keys: tuple[str, ...] = ("sensor_id",)

    def fresh(self, level: str) -> str:
        """Partials as the batches wrote them, by batch: files are ranges of time, whatever days a batch holds."""
        return f"{self.root}/{level}/fresh"

    def merged(self, level: str) -> str:
        """Partials of many batches, by year, month (``FOLDERS``) or day, one row per bucket."""
        return f"{self.root}/{level}/merged"

    def partials(self, rows: DataFrame, width: dt.timedelta = MINUTE) -> DataFrame:
        """Mergeable partials of readings. A null measure counts as a row but adds no value."""
        found = [F.count(F.lit(1)).alias("n")]
        for name in self.measures:
            found += [
                F.count(name).alias(f"{name}_count"),
                F.sum(name).alias(f"{name}_sum"),
                F.min(name).alias(f"{name}_min"),
                F.max(name).alias(f"{name}_max"),
            ]
        return rows.groupBy(time_bucket(_width_text(width)).alias("time"), *self.keys).agg(*found)

    def combine(self, partials: DataFrame, *by: str | Column) -> DataFrame:
        """Partials added up over ``by``."""
        found = [F.sum("n").alias("n")]
        for name in self.measures:
            found += [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for part in ("count", "sum")]
            found += [F.min(f"{name}_min").alias(f"{name}_min"), F.max(f"{name}_max").alias(f"{name}_max")]
        return partials.groupBy(*by).agg(*found)

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Adds a batch of readings, of any days, to every level; a repeated batch replaces itself."""
        minutes = self.partials(rows).persist()
        try:
            self._store(minutes, "minute", batch_id)
            run_together(rows.sparkSession, [partial(self._store, self._coarser(minutes, LEVELS[level]), level, batch_id) for level in ("day", "hour")])
        finally:
            minutes.unpersist()

    def _store(self, partials: DataFrame, level: str, batch_id: int) -> None:
        overwrite_batch(in_folders(partials, level), self.fresh(level), batch_id, order=("time",))

    def forget(self, spark: SparkSession, batch_id: int) -> None:
        """Deletes what an unfinished attempt at a batch added."""
        for level in LEVELS:
            drop_batch(spark, self.fresh(level), batch_id)

    def _coarser(self, partials: DataFrame, width: dt.timedelta) -> DataFrame:
        return self.combine(partials, time_bucket(_width_text(width)).alias("time"), *self.keys)

    def merge(self, spark: SparkSession) -> None:
        """Merges the batches' partials into one row per bucket. The newest batch stays as it
        is, because a restarted stream may write that one again."""

        def merged(level: str) -> None:
            compact(
                spark,
                self.fresh(level),
                self.merged(level),
                combine=lambda partials: self.combine(partials, "time", *self.keys),
                newest_stays=True,
                dated=lambda partials: in_folders(partials, level),
            )

        run_together(spark, [partial(merged, level) for level in LEVELS])

    def read(self, spark: SparkSession, level: str) -> DataFrame:
        """Partials of a level, also those not merged yet: several rows per bucket."""
        parts = []
        if path_exists(spark, self.merged(level)) and stored_days(spark, self.merged(level)):
            parts.append(spark.read.parquet(self.merged(level)))
        if batch_folders(spark, self.fresh(level)):
            parts.append(spark.read.parquet(self.fresh(level)).drop("batch_id"))
        if not parts:
            raise FileNotFoundError(f"no partials below {self.root}")
        return reduce(lambda a, b: a.unionByName(b), parts)

    def covering(
        self,
        readings: DataFrame,
        start: dt.datetime | None = None,
        end: dt.datetime | None = None,
        width: dt.timedelta | None = None,
    ) -> DataFrame:
        """Partials that add up to ``start <= time <= end``, no bucket crossing one of ``width``.

        ``readings`` is the day-partitioned table the batches came from; of it, only the
        days of the two bounds are opened, and none at all if both lie on whole minutes.
        """
        spark = readings.sparkSession
        pieces = cover(start or FIRST, end + INSTANT if end else LAST, levels_within(width))
        if not pieces:
            return self.partials(readings.where(F.lit(False)))
        parts = []
        for level in dict.fromkeys(level for level, _, _ in pieces):
            ranges = [(a, b) for name, a, b in pieces if name == level]
            table = readings if level == RAW else self.read(spark, level)
            found = table.where(reduce(Column.__or__, [_within(table, level, a, b) for a, b in ranges]))
            parts.append(self.partials(found) if level == RAW else found.drop(DATE))
        return reduce(lambda a, b: a.unionByName(b), parts)

    def summary(
        self,
        readings: DataFrame,
        start: dt.datetime | None = None,
        end: dt.datetime | None = None,
        width: dt.timedelta | None = None,
        by: Sequence[str] = (),
    ) -> DataFrame:
        """Rows (``n``) and mean, minimum and maximum of every measure for ``start <= time <= end``:
        in all, per bucket of ``width`` (column ``time``) and per column of ``by``, some of the
        keys. Without ``width`` and ``by`` an empty range gives one row, as in SQL."""
        bucket = [time_bucket(_width_text(width)).alias("time")] if width else []
        found = self.combine(self.covering(readings, start, end, width), *bucket, *by)
        columns = [F.coalesce("n", F.lit(0)).alias("n")]
        for name in self.measures:
            mean = F.try_divide(f"{name}_sum", f"{name}_count")
            columns += [mean.alias(f"avg_{name}"), F.col(f"{name}_min").alias(f"min_{name}"), F.col(f"{name}_max").alias(f"max_{name}")]
        return found.select(*(["time"] if width else []), *by, *columns)


def _within(table: DataFrame, level: str, start: dt.datetime, end: dt.datetime) -> Column:
    """``start <= time < end``, with the days it touches for tables that have them as folders."""
    first = start.date()
    if level in FOLDERS:  # named by their first day
        first = first.replace(day=1, month=1 if level == "day" else first.month)
    inside = (F.col("time") >= time_literal(table, start)) & (F.col("time") < time_literal(table, end))
    if DATE not in table.columns:
        return inside
    return inside & F.col(DATE).between(F.lit(first), F.lit((end - INSTANT).date()))
