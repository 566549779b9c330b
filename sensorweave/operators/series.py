"""Rate of change, moving-average anomalies and rolling batch statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.functions.timing import elapsed_seconds, time_filter
from sensorweave.operators.ordering import rolling, rolling_apply, rolling_stored, tie_columns
from sensorweave.operators.readings import Moment
from sensorweave.schemas import HUMIDITY_ANOMALY, NORMAL_STATUS, ROLLING_BATCHES, TEMPERATURE_ANOMALY

SENSOR = ("sensor_id",)


def rate_of_change(
    df: DataFrame,
    keys: Sequence[str] = SENSOR,
    tie_break: Sequence[str] | None = None,
    block_rows: int | None = None,
    small_groups: bool = False,
    start: Moment = None,
    end: Moment = None,
    stored_order: bool = False,
) -> DataFrame:
    """Change per second against the previous reading; a series' first row is left out.

    Readings at the same instant have rate 0. ``keys=()`` takes all sensors as
    one series. Readings outside ``start`` to ``end`` do not count, also not as previous
    ones. ``stored_order`` says that ``df`` is read from files written in the order of
    time and tie-break, which saves sorting them (see ``rolling_stored``).
    """

    def previous(window: WindowSpec) -> dict:
        return {
            "_temperature": F.lag("temperature").over(window),
            "_humidity": F.lag("humidity").over(window),
            "_time": F.lag("time").over(window),
        }

    tie_break = tie_columns(df, tie_break)
    columns = ["time", "sensor_id", "temperature", "humidity", *tie_break]
    source = time_filter(df, start, end).select(*columns)
    if stored_order:
        rows = rolling_stored(source, ["time", *tie_break], 1, previous, keys)
    else:
        rows = rolling(source, ["time", *tie_break], 1, previous, keys, block_rows, small_groups)
    seconds = elapsed_seconds(df, "_time", "time")
    rows = rows.where(F.col("_time").isNotNull()).withColumn("_seconds", seconds)

    def rate(name: str):
        change = (F.col(name) - F.col(f"_{name}")) / F.col("_seconds")
        return F.when(F.col("_seconds") > 0, change).otherwise(F.lit(0.0))

    return rows.select(
        "time",
        "sensor_id",
        rate("temperature").alias("temp_change_rate"),
        rate("humidity").alias("hum_change_rate"),
    )


def anomalies(
    df: DataFrame,
    keys: Sequence[str] = SENSOR,
    tie_break: Sequence[str] | None = None,
    preceding: int = 10,
    deviations: float = 2.0,
    block_rows: int | None = None,
    small_groups: bool = False,
    start: Moment = None,
    end: Moment = None,
    stored_order: bool = False,
) -> DataFrame:
    """Readings further than ``deviations`` sample deviations from their moving mean.

    The frame is the row and its ``preceding`` predecessors. A frame of one row
    has no deviation and is never flagged; a temperature anomaly hides a
    humidity anomaly of the same row. ``start``, ``end`` and ``stored_order`` are those of
    ``rate_of_change``.
    """

    def moments(window: WindowSpec) -> dict:
        frame = window.rowsBetween(-preceding, 0)
        return {
            "_t_avg": F.avg("temperature").over(frame),
            "_t_sd": F.stddev_samp("temperature").over(frame),
            "_h_avg": F.avg("humidity").over(frame),
            "_h_sd": F.stddev_samp("humidity").over(frame),
        }

    tie_break = tie_columns(df, tie_break)
    columns = ["time", "sensor_id", "temperature", "humidity", *tie_break]
    source = time_filter(df, start, end).select(*columns)
    if stored_order:
        rows = rolling_stored(source, ["time", *tie_break], preceding, moments, keys)
    else:
        rows = rolling(source, ["time", *tie_break], preceding, moments, keys, block_rows, small_groups)
    hot = F.abs(F.col("temperature") - F.col("_t_avg")) > F.lit(deviations) * F.col("_t_sd")
    wet = F.abs(F.col("humidity") - F.col("_h_avg")) > F.lit(deviations) * F.col("_h_sd")
    status = F.when(hot, TEMPERATURE_ANOMALY).when(wet, HUMIDITY_ANOMALY).otherwise(NORMAL_STATUS)
    return rows.where(hot | wet).select("time", "sensor_id", "temperature", "humidity", *tie_break, status.alias("status"))


def newest_anomalies(df: DataFrame, n: int = 10, tie_break: Sequence[str] | None = None, **options) -> DataFrame:
    tie_break = tie_columns(df, tie_break)
    flagged = anomalies(df, tie_break=tie_break, **options)
    newest = [F.col("time").desc(), *[F.col(c).desc() for c in tie_break]]
    return flagged.orderBy(*newest).limit(n)


def frame_statistics(size: int) -> Callable:
    """Function from a series to the statistics of the frames that end at each of its values.

    A frame holds the last ``size`` values. Missing values (``present`` is false) take a place in it
    but count in nothing; NaN is the largest number. The deviation of one value is 0, and
    a frame without values has the count 0, the deviation 0 and else NaN.
    """

    def statistics(values, present):
        import numpy as np
        from numpy.lib.stride_tricks import sliding_window_view

        width = min(size, max(len(values), 1))
        lead = np.full(width - 1, np.nan)
        # Missing values and NaN sort behind all numbers, so ranks below the count find the values.
        known = np.concatenate([lead, np.where(present, values, np.nan)])
        seen = np.concatenate([np.zeros(width - 1, "int64"), present.astype("int64")])
        counts = sliding_window_view(seen, width).sum(axis=1) if len(values) else seen[:0]
        found = {name: np.full(len(values), np.nan) for name in ("avg", "min", "max", "stddev", "median")}
        step = max(2_000_000 // width, 1)  # 16 MB of frames at a time
        for first in range(0, len(values), step):
            n = counts[first : first + step]
            frames = np.sort(sliding_window_view(known, width)[first : first + step], axis=1)
            row, some = np.arange(len(n)), n > 0
            inside = np.arange(width) < n[:, None]
            mean = np.where(inside, frames, 0.0).sum(axis=1) / np.maximum(n, 1)
            square = (np.where(inside, frames - mean[:, None], 0.0) ** 2).sum(axis=1)
            upper = frames[row, n // 2]
            lower = frames[row, np.maximum(n - 1, 0) // 2]
            shown = {
                "avg": mean,
                "min": frames[:, 0],
                "max": frames[row, np.maximum(n, 1) - 1],
                "stddev": np.where(n > 1, np.sqrt(square / np.maximum(n - 1, 1)), 0.0 * mean),
                "median": (lower + upper) / 2,
            }
            for name, value in shown.items():
                found[name][first : first + step] = np.where(some, value, 0.0 if name == "stddev" else np.nan)
        return found, counts

    return statistics


def rolling_batch_stats(
    batches: DataFrame,
    order_by: Sequence[str],
    size: int = ROLLING_BATCHES,
    block_rows: int | None = None,
) -> DataFrame:
    """Mean, min, max, median and deviation of the last ``size`` batch times.

    All batches form one series. The deviation of a single sample is 0; missing times count in nothing.
    Spark takes no ordered frame for a median, so blocks of the series are measured by Arrow batches.
    """
    statistics = frame_statistics(size)
    names = {f"{name}_processing_time": name for name in ("avg", "min", "max", "stddev", "median")}

    def measure(block):
        import pyarrow as pa

        times = block["processing_time"].combine_chunks()
        found, counts = statistics(
            times.cast("float64").fill_null(float("nan")).to_numpy(zero_copy_only=False),
            times.is_valid().to_numpy(zero_copy_only=False),
        )
        empty = counts == 0
        columns = {
            column: pa.array(found[name], mask=empty & (name != "stddev")) for column, name in names.items()
        }
        return columns | {"sample_size": pa.array(counts, "int32")}

    added = [T.StructField(name, T.DoubleType()) for name in names] + [T.StructField("sample_size", T.IntegerType())]
    return rolling_apply(batches, order_by, max(size - 1, 1), measure, added, block_rows or 5 * size)
