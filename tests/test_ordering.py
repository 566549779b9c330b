"""Block windows and ranked quantiles against their plain forms, skew included."""

import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorweave.operators import ordering
from sensorweave.operators.quantiles import group_stats
from sensorweave.operators.series import anomalies, rate_of_change, rolling_batch_stats
from sensorweave.plans import fixtures as fx


@pytest.fixture(autouse=True)
def several_partitions(spark):
    """Keeps small test data from being merged into one partition."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


def skewed(spark, n=600):
    """A third of the rows at one instant, most of the rest in one series."""
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id") * 7 % 401).alias("t"),
        F.when(F.col("id") % 5 == 0, F.concat(F.lit("k"), F.col("id") % 4)).otherwise("hot").alias("k"),
        ((F.col("id") * 37) % 101).cast("double").alias("x"),
    )


def measures(preceding):
    def build(window):
        frame = window.rowsBetween(-preceding, 0)
        return {"total": F.sum("x").over(frame), "rows": F.count("x").over(frame), "before": F.lag("x").over(window)}

    return build


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize(("preceding", "block_rows"), [(1, 1), (1, 7), (10, 10), (10, 37), (10, 1000), (99, 120)])
def test_blocks_equal_plain_window(spark, keys, preceding, block_rows):
    df = skewed(spark)
    plain = Window.partitionBy(*keys).orderBy("t", "id")
    expected = df.select("*", *[c.alias(n) for n, c in measures(preceding)(plain).items()])
    actual = ordering.rolling(df, ["t", "id"], preceding, measures(preceding), keys, block_rows)
    assert actual.columns == expected.columns
    assert sorted(actual.collect()) == sorted(expected.collect())


def test_positions_are_dense_and_ordered(spark):
    rows = ordering.with_position(skewed(spark), ["t", "id"]).orderBy("_position").collect()
    assert [r._position for r in rows] == list(range(600))
    assert [(r.t, r.id) for r in rows] == sorted((r.t, r.id) for r in rows)


def test_one_instant_spreads_over_partitions(spark):
    df = skewed(spark, 6000)
    staged = ordering.staged_order(df, ["t", "id"])
    sizes = [r["count"] for r in staged.groupBy("_part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 6000 / 2


def test_partition_count_grows_with_the_rows(spark):
    df = spark.range(1)
    assert ordering.partitions_for(df, 1000) == []
    assert ordering.partitions_for(df, 40 * ordering.PARTITION_ROWS + 1) == [41]
    assert ordering.partitions_for(df, 10_000, 499) == [3]
    assert ordering.partitions_for(df, 1_000_000, 499) == [4]
    with pytest.raises(ValueError):
        ordering.partitions_for(df, 10**15)


def test_many_partitions_give_the_same_windows(spark, monkeypatch):
    monkeypatch.setattr(ordering, "PARTITION_ROWS", 50)
    df = skewed(spark)
    expected = df.select("*", *[c.alias(n) for n, c in measures(10)(Window.orderBy("t", "id")).items()])
    actual = ordering.rolling(df, ["t", "id"], 10, measures(10), block_rows=25)
    assert sorted(actual.collect()) == sorted(expected.collect())


def test_small_groups_skip_the_blocks(spark):
    plan = ordering.rolling(skewed(spark), ["t", "id"], 1, measures(1), ["k"], small_groups=True)._jdf.queryExecution().toString()
    assert "_block" not in plan


def test_block_smaller_than_frame_is_refused(spark):
    with pytest.raises(ValueError):
        ordering.rolling(skewed(spark), ["t", "id"], 10, measures(10), block_rows=9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=60),
    preceding=st.integers(1, 6),
    extra=st.integers(0, 9),
)
def test_blocks_equal_plain_window_for_any_series(spark, values, preceding, extra):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "t int, x double")
    plain = Window.orderBy("t")
    expected = df.select("*", *[c.alias(n) for n, c in measures(preceding)(plain).items()])
    actual = ordering.rolling(df, ["t"], preceding, measures(preceding), block_rows=preceding + extra)
    assert sorted(actual.collect(), key=lambda r: r.t) == sorted(expected.collect(), key=lambda r: r.t)


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_ranked_quantiles_equal_builtin(spark, keys):
    df = skewed(spark, 3000).withColumn("x", F.when(F.col("id") % 11 != 0, F.col("x")))
    df = df.unionByName(spark.createDataFrame([(9999, 1, "only null", None), (9998, 1, "one", 4.5)], df.schema))
    wanted = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p0": 0.0, "p100": 1.0}

    def result(small):
        rows = group_stats(df, keys, "x", wanted, counted=True, small_groups=small).collect()
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in rows)

    assert result(False) == result(True)


def test_approximate_quantiles_are_close(spark):
    df = spark.range(10001).select(F.col("id").cast("double").alias("x"))
    row = group_stats(df, [], "x", {"p95": 0.95}, approximate=10000).first()
    assert abs(row.p95 - 9500) <= 2


@pytest.mark.parametrize("operator", [rate_of_change, anomalies])
def test_hot_sensor_equals_plain(spark, sf_dir, operator):
    df = fx.sensor_data(spark, sf_dir)
    plain = operator(df, tie_break=["event_id"], small_groups=True)
    blocked = operator(df, tie_break=["event_id"], block_rows=50)
    assert sorted(map(str, plain.collect())) == sorted(map(str, blocked.collect()))


def test_rolling_batches_for_any_block_size(spark, sf_dir):
    batches = fx.batch_times(fx.sensor_data(spark, sf_dir))

    def result(block_rows):
        rows = rolling_batch_stats(batches, ["batch"], size=20, block_rows=block_rows).orderBy("batch").collect()
        return [tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in rows]

    assert result(19) == result(33) == result(5000)
    assert result(19)[0][6] == 0.0 or 0.0 in result(19)[0]


def test_scratch_is_below_the_session_folder_and_can_be_released(spark):
    from sensorweave import session

    staged = ordering.staged_order(skewed(spark), ["t", "id"])
    folder = session.application_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.list_folders(spark, folder) and staged.count() == 600
    session.release_scratch(spark)
    with pytest.raises(Exception):
        session.list_folders(spark, folder)


# --- statistics of frames -----------------------------------------------------

def naive_statistics(values, size):
    """Per value: mean, min, max, deviation and median of the last ``size`` places, NaN as the largest number."""
    out = []
    for end in range(1, len(values) + 1):
        frame = sorted((v for v in values[max(end - size, 0) : end] if v is not None), key=lambda v: (math.isnan(v), v))
        if not frame:
            out.append((None, None, None, 0.0, None, 0))
            continue
        n, broken = len(frame), any(math.isnan(v) for v in frame)
        spread = 0.0 if n == 1 else math.nan if broken else statistics.stdev(frame)
        mean = math.nan if broken else statistics.fmean(frame)
        if n == 1 and broken:
            spread = math.nan
        out.append((mean, frame[0], frame[-1], spread, (frame[(n - 1) // 2] + frame[n // 2]) / 2, n))
    return out


@pytest.mark.parametrize("size,block", [(1, 3), (2, 1), (5, 2), (5, 7), (40, 6), (100, None)])
def test_frame_statistics_over_blocks_equal_the_naive_ones(spark, size, block):
    rng = random.Random(size)
    values = [rng.choice([None, 1.0, 2.0, 2.0, -3.5, rng.random()]) for _ in range(57)]
    values[20] = math.nan
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(values)], "n int, processing_time double, kept string")
    got = rolling_batch_stats(df, ["n"], size, block).orderBy("n").collect()
    names = ["avg", "min", "max", "stddev", "median"]
    found = [(*[r[f"{name}_processing_time"] for name in names], r.sample_size) for r in got]
    assert [r.kept for r in got] == ["x"] * len(values)
    for mine, plain in zip(found, naive_statistics(values, size), strict=True):
        assert [v is None for v in mine] == [v is None for v in plain]
        assert [v for v in mine if v is not None] == pytest.approx([v for v in plain if v is not None], nan_ok=True)


def test_statistics_of_no_batches(spark):
    df = spark.createDataFrame([], "n int, processing_time double")
    assert rolling_batch_stats(df, ["n"]).count() == 0
