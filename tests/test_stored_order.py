"""Windows over files in stored order against plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorweave.operators.ordering import rolling_stored
from sensorweave.operators.series import anomalies, rate_of_change
from sensorweave.session import application_folder, list_folders, path_exists, scratch_path
from sensorweave.sources.tables import read_table, write_sorted

COLUMNS = ["t", "id", "k", "x"]


def many_files(spark, rows, files, keep_order=True):
    """Rows as files that are ranges of the order (t, id), or that are not."""
    path = scratch_path(spark, "slices")
    rows = sorted(rows) if keep_order else rows
    size = -(-len(rows) // files)
    numbered = [(*row, f"{i // size:08d}") for i, row in enumerate(rows)]
    frame = spark.createDataFrame(numbered, "t int, id int, k string, x double, part string")
    frame.coalesce(1).write.partitionBy("part").parquet(path)
    return spark.read.parquet(path).drop("part")


def measures(preceding):
    def build(window):
        frame = window.rowsBetween(-preceding, 0)
        return {"mean": F.avg("x").over(frame), "n": F.count(F.lit(1)).over(frame), "before": F.lag("x", preceding).over(window)}

    return build


def rounded_rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in df.na.fill(-1.0).collect())


def series(seed, n=400):
    pick = random.Random(seed)
    # Rare keys skip files; a third of the rows are one key at one instant.
    rows = [(pick.randint(0, 150), i, pick.choice("aaaaaab") + ("" if i % 60 else "rare"), pick.random()) for i in range(n)]
    return rows + [(77, n + i, "a", pick.random()) for i in range(n // 2)]


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize(("preceding", "files"), [(1, 40), (3, 200), (10, 25), (500, 9)])
def test_windows_equal_plain_ones(spark, keys, preceding, files):
    df = many_files(spark, series(preceding), files)
    plain = Window.partitionBy(*keys).orderBy("t", "id")
    expected = df.select("*", *[c.alias(n) for n, c in measures(preceding)(plain).items()])
    found = rolling_stored(df, ["t", "id"], preceding, measures(preceding), keys)
    assert found.columns == expected.columns
    assert rounded_rows(found) == rounded_rows(expected)


def test_ties_are_taken_file_by_file(spark):
    """Where the order leaves rows tied, every row still has exactly its predecessors."""
    rows = [(5, i, "a", float(i)) for i in range(60)]
    df = many_files(spark, rows, 7)
    found = rolling_stored(df, ["t"], 4, measures(4), ["k"]).select("n").collect()
    assert sorted(r.n for r in found) == [1, 2, 3, 4] + [5] * 56


def test_files_that_interleave_are_refused(spark):
    rows = series(9)
    random.Random(1).shuffle(rows)
    df = many_files(spark, rows, 12, keep_order=False)
    with pytest.raises(Exception, match="no disjoint ranges"):
        rolling_stored(df, ["t", "id"], 3, measures(3), ["k"]).collect()


def test_rows_from_no_file_are_one_range(spark):
    df = spark.createDataFrame(series(4), "t int, id int, k string, x double")
    expected = df.select("*", *[c.alias(n) for n, c in measures(2)(Window.partitionBy("k").orderBy("t", "id")).items()])
    assert rounded_rows(rolling_stored(df, ["t", "id"], 2, measures(2), ["k"])) == rounded_rows(expected)
    assert rolling_stored(df.limit(0), ["t", "id"], 2, measures(2), ["k"]).collect() == []
    with pytest.raises(ValueError):
        rolling_stored(df, ["t"], 0, measures(1))


@pytest.mark.parametrize("operator", [rate_of_change, anomalies])
def test_stored_days_equal_the_blocks(spark, make_readings, operator):
    """Several days and files of one table, with bounds, without a copy left behind."""
    pick = random.Random(11)
    rows = [(pick.randint(0, 260_000), pick.gauss(20, 3), pick.gauss(50, 9), f"s{pick.choice([0, 0, 0, 1, 2])}") for _ in range(900)]
    path = scratch_path(spark, "days")
    numbered = make_readings(*rows).withColumn("event_id", F.monotonically_increasing_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_sorted(numbered, path, order=("time", "event_id"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    table = read_table(spark, path)
    assert len(table.inputFiles()) > 4
    times = sorted(r.time for r in numbered.select("time").collect())
    for bounds in ({}, {"start": times[200], "end": times[700]}):
        for keys in ((), ("sensor_id",)):
            blocks = operator(table, keys=keys, tie_break=["event_id"], block_rows=60, **bounds)
            expected = rounded_rows(blocks)
            before = list_folders(spark, application_folder(spark))
            assert rounded_rows(operator(table, keys=keys, tie_break=["event_id"], stored_order=True, **bounds)) == expected
            assert expected and list_folders(spark, application_folder(spark)) == before
    assert path_exists(spark, path)
