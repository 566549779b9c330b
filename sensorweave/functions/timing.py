"""Time buckets, epochs, and absolute and relative time filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = dt.datetime(1970, 1, 1)
DATE = "date"


def time_bucket(width: str, time: str | Column = "time") -> Column:
    """Start of the tumbling bucket that holds ``time``."""
    return F.window(time, width)["start"]


def is_ntz(df: DataFrame, column: str = "time") -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampNTZType)


def elapsed_seconds(df: DataFrame, start: str | Column, end: str | Column, column: str = "time") -> Column:
    """Seconds with fraction from ``start`` to ``end``, both of ``column``'s type.

    Neither form looks at the session time zone, so clock changes do not count.
    """
    start, end = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    if is_ntz(df, column):
        return (end - start).cast("interval second").cast("decimal(20,6)").cast("double")
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def epoch_seconds(df: DataFrame, column: str = "time") -> Column:
    """UNIX seconds with fraction, independent of the session time zone."""
    return elapsed_seconds(df, time_literal(df, EPOCH, column), column, column)


def instant_to_ntz(column: str | Column) -> Column:
    """UTC wall-clock time of an instant, independent of the session time zone."""
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.unix_micros(column) * F.expr("INTERVAL '0.000001' SECOND")


def time_literal(df: DataFrame, value: dt.datetime, column: str = "time") -> Column:
    """``value`` as a literal of the column's own type, so that it can be pushed down.

    Values for an instant column without a zone of their own are UTC.
    """
    if is_ntz(df, column):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit(_micros(value)))


def _micros(value: dt.datetime) -> int:
    delta = value.astimezone(dt.timezone.utc).replace(tzinfo=None) - EPOCH
    return delta // dt.timedelta(microseconds=1)


def _as_utc_naive(df: DataFrame, expression: Column, column: str) -> Column:
    return expression if is_ntz(df, column) else instant_to_ntz(expression)


def latest_time(df: DataFrame, column: str = "time") -> dt.datetime | None:
    """Newest ``time`` as naive UTC: one row to the driver.

    On a date-partitioned table the newest day is known from folder names, and only
    its files are opened; further days follow only where filters leave it empty.
    """
    newest = _as_utc_naive(df, F.max(column), column)
    for day in reversed(folder_days(df)):
        found = df.where(F.col(DATE) == F.lit(day)).agg(newest).first()[0]
        if found is not None:
            return found
    return df.agg(newest).first()[0]


def folder_days(df: DataFrame) -> list[dt.date]:
    """Days among the table's folders, oldest first, from paths alone; empty if it has none."""
    if DATE not in df.columns:
        return []
    found = {part for path in df.inputFiles() for part in path.split("/") if part.startswith(f"{DATE}=")}
    names = [part.removeprefix(f"{DATE}=") for part in found]
    return sorted(dt.date.fromisoformat(name) for name in names if name[:1].isdigit())


def time_bounds(df: DataFrame, column: str = "time") -> tuple[dt.datetime | None, dt.datetime | None]:
    """Oldest and newest ``time`` as naive UTC: one row to the driver."""
    low, high = (_as_utc_naive(df, f(column), column) for f in (F.min, F.max))
    return tuple(df.agg(low.alias("low"), high.alias("high")).first())


def resolve_as_of(df: DataFrame, as_of: dt.datetime | None, column: str = "time") -> dt.datetime:
    """The moment that relative windows count back from; the newest row by default."""
    if as_of is not None:
        return as_of
    return latest_time(df, column) or EPOCH


def since(df: DataFrame, window: dt.timedelta, as_of: dt.datetime | None = None, column: str = "time") -> DataFrame:
    """Rows with ``as_of - window < time <= as_of``."""
    end = resolve_as_of(df, as_of, column)
    start = end - window
    out = df.where(F.col(column) > time_literal(df, start, column))
    return time_filter(_prune_days(out, start=start), end=end, column=column)


def time_filter(
    df: DataFrame,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    column: str = "time",
) -> DataFrame:
    """Rows with ``start <= time <= end``; an open side is not filtered."""
    if start is not None:
        df = df.where(F.col(column) >= time_literal(df, start, column))
    if end is not None:
        df = df.where(F.col(column) <= time_literal(df, end, column))
    return _prune_days(df, start=start, end=end)


def _prune_days(df: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
    # A time predicate alone opens every day's files; the day predicate skips folders.
    if DATE not in df.columns:
        return df
    if start is not None:
        df = df.where(F.col(DATE) >= F.lit(_utc_date(start)))
    if end is not None:
        df = df.where(F.col(DATE) <= F.lit(_utc_date(end)))
    return df


def _utc_date(value: dt.datetime) -> dt.date:
    return (value.astimezone(dt.timezone.utc) if value.tzinfo else value).date()


def with_date(df: DataFrame, column: str = "time") -> DataFrame:
    """Adds the UTC day used as partition column."""
    return df.withColumn(DATE, _as_utc_naive(df, F.col(column), column).cast("date"))


def age_seconds(df: DataFrame, as_of: dt.datetime, column: str = "time") -> Column:
    """Seconds from ``time`` to ``as_of``."""
    return elapsed_seconds(df, column, time_literal(df, as_of, column), column)
