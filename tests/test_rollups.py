import datetime as dt
import random

import pytest
from instants import T0

from sensorweave.functions.timing import time_filter
from sensorweave.operators.rollups import LEVELS, RAW, Rollup, cover, levels_within
from sensorweave.session import delete_path, scratch_path
from sensorweave.sources.tables import append, read_table, stored_days

DAY, HOUR, MINUTE = dt.timedelta(days=1), dt.timedelta(hours=1), dt.timedelta(minutes=1)


def some_bounds(n=300):
    pick = random.Random(5)
    for _ in range(n):
        start = T0 + dt.timedelta(seconds=pick.randint(0, 400_000), microseconds=pick.choice([0, 0, 1, 999_999]))
        yield start, start + pick.choice([dt.timedelta(microseconds=1), MINUTE, 90 * MINUTE, 3 * DAY]) * pick.randint(0, 3)
    yield T0, T0 + DAY
    yield T0 - 12 * HOUR, T0 + 12 * HOUR


def test_pieces_cover_a_range_once_with_whole_buckets():
    for start, end in some_bounds():
        pieces = cover(start, end, list(LEVELS))
        at = start
        for level, first, last in pieces:
            assert first == at < last
            at = last
            if level == RAW:
                assert last - first < 2 * MINUTE
            else:
                width = LEVELS[level]
                assert (first - dt.datetime(1970, 1, 1)) % width == (last - first) % width == dt.timedelta(0)
        assert at == end or (start >= end and not pieces)
        # At most one run of days, and two runs of every finer level.
        assert len(pieces) <= 7


def test_levels_that_fit_a_bucket_width():
    assert levels_within(None) == ["day", "hour", "minute"]
    assert levels_within(2 * HOUR) == ["hour", "minute"]
    assert levels_within(15 * MINUTE) == ["minute"]
    assert levels_within(dt.timedelta(seconds=30)) == []


@pytest.fixture
def stored(spark, make_readings):
    """Four days of readings as a table and as a rollup of three batches, the last one late rows."""
    pick = random.Random(6)
    rows = [
        (pick.randint(0, 4 * 86_400 * 10) / 10, pick.choice([None, pick.uniform(10, 30)]), pick.uniform(20, 60), f"s{pick.randint(0, 2)}")
        for _ in range(3000)
    ]
    path, rollup = scratch_path(spark, "raw"), Rollup(scratch_path(spark, "rollup"))
    for batch, part in enumerate((rows[:1500], rows[1500:2500], rows[2500:])):
        append(make_readings(*part), path)
        rollup.add(make_readings(*part), batch)
    return read_table(spark, path), rollup, path


def plain_summary(df, start, end, by=()):
    from pyspark.sql import functions as F

    measures = [f(m).alias(f"{name}_{m}") for m in ("temperature", "humidity") for name, f in (("avg", F.avg), ("min", F.min), ("max", F.max))]
    return time_filter(df, start, end).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *measures)


def same(found, expected):
    def rows(df):
        return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in df.collect()], key=str)

    assert found.columns == expected.columns
    assert rows(found) == rows(expected)


RANGES = [
    (T0 + 3 * HOUR + dt.timedelta(seconds=11.5), T0 + 3 * DAY + dt.timedelta(seconds=7)),
    (T0 + MINUTE, T0 + 2 * HOUR),
    (T0 + dt.timedelta(seconds=1), T0 + dt.timedelta(seconds=40)),
    (T0 + 9 * DAY, T0 + 10 * DAY),
    (None, T0 + DAY),
    (T0 + DAY, None),
    (None, None),
]


def test_ranges_equal_the_readings_before_and_after_merging(spark, stored, make_readings):
    readings, rollup, _ = stored
    for _ in range(2):
        for start, end in RANGES:
            same(rollup.summary(readings, start, end), plain_summary(readings, start, end))
            found = rollup.summary(readings, start, end, by=["sensor_id"])
            same(found, plain_summary(readings, start, end, ["sensor_id"]))
        rollup.merge(spark)


def test_a_repeated_batch_replaces_itself_also_after_a_merge(spark, stored, make_readings):
    readings, rollup, _ = stored
    late = make_readings((5, 1.0, 2.0), (86_405, 3.0, 4.0))
    for _ in range(3):
        rollup.add(late, 3)
        rollup.merge(spark)
    total = rollup.summary(readings).first()["n"]
    assert total == readings.count() + 2
    # One row per bucket is left of the merged batches.
    merged = spark.read.parquet(rollup.merged("minute"))
    assert merged.count() == merged.select("time", "sensor_id").distinct().count()


def test_inner_days_of_the_readings_are_not_needed(spark, stored):
    """The folders of the days between the bounds may even be gone."""
    readings, rollup, path = stored
    start, end = T0 + 90.5 * MINUTE, T0 + 3 * DAY + dt.timedelta(seconds=33)
    expected = [tuple(r) for r in plain_summary(readings, start, end).collect()]
    days = stored_days(spark, path)
    for day in days:
        if start.date() < day < end.date():
            delete_path(spark, f"{path}/date={day.isoformat()}")
    left = read_table(spark, path)
    assert len(stored_days(spark, path)) < len(days)
    found = rollup.summary(left, start, end)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert [[round(v, 9) for v in r] for r in found.collect()] == [[round(v, 9) for v in r] for r in expected]


def test_whole_minutes_read_no_readings(spark, stored):
    readings, rollup, _ = stored
    start, end = T0 + MINUTE, T0 + 2 * DAY - dt.timedelta(microseconds=1)
    pieces = {level for level, _, _ in cover(start, end + dt.timedelta(microseconds=1), list(LEVELS))}
    assert RAW not in pieces
    same(rollup.summary(readings, start, end), plain_summary(readings, start, end))


def test_no_partials_at_all_is_an_error(spark, make_readings):
    with pytest.raises(FileNotFoundError):
        Rollup(scratch_path(spark, "none")).read(spark, "day")


def test_a_stream_keeps_partials_of_all_its_batches(spark, make_readings, tmp_path):
    """Three files, one of them late, with a restart between; merging runs after every batch."""
    from sensorweave.config import IngestConfig
    from sensorweave.streaming import aggregates

    config = IngestConfig(table_root=str(tmp_path / "tables"), checkpoint_root=str(tmp_path / "checkpoints"))
    rollup, source = aggregates.stream_rollup(config), str(tmp_path / "in")
    parts = ([(i * 20, float(i), 1.0) for i in range(200)], [(90_000 + i, 2.0, 3.0) for i in range(50)], [(31, 9.0, 9.0)])
    everything = []
    for part in parts:
        rows = make_readings(*part)
        rows.write.mode("append").parquet(source)
        everything += part
        stream = spark.readStream.schema(rows.schema).parquet(source)
        aggregates.rollup_writer(stream, config, merge_every=1).trigger(availableNow=True).start().awaitTermination()
        same(rollup.summary(rollup.read(spark, "hour"), by=["sensor_id"]), plain_summary(make_readings(*everything), None, None, ["sensor_id"]))


def test_coarse_levels_of_many_days_are_few_files(spark, make_readings, tmp_path):
    """Batches are no folders by day, and merged hours and days are folders by month and year."""
    rows = [(day * 86_400 + 7, float(day), 1.0) for day in range(70)]
    readings, rollup = make_readings(*rows).repartition(8), Rollup(str(tmp_path / "rollup"))
    for batch in range(2):
        rollup.add(readings, batch)
        files = [len(list((tmp_path / "rollup" / level / "fresh" / f"batch_id={batch}").rglob("*.parquet"))) for level in LEVELS]
        assert all(1 <= n <= 4 for n in files), files  # one per task at most
    doubled = readings.unionAll(readings)
    for _ in range(2):
        for start, end in [(T0 + 40 * DAY, T0 + 41 * DAY), (T0 + 3 * DAY + 5 * HOUR, T0 + 65 * DAY + HOUR), (None, None)]:
            same(rollup.summary(doubled, start, end), plain_summary(doubled, start, end))
        rollup.merge(spark)
    folders = {level: len(stored_days(spark, rollup.merged(level))) for level in LEVELS}
    assert folders == {"day": 1, "hour": 3, "minute": 70}


def test_actions_run_together_and_their_errors_are_raised(spark):
    from sensorweave.session import run_together

    done = []

    def fail():
        raise ValueError("broken")

    with pytest.raises(ValueError, match="broken"):
        run_together(spark, [fail, lambda: done.append(spark.range(10).count())])
    assert done == [10]
    run_together(spark, [])
