import datetime as dt

import pytest
from instants import T0
from pyspark.sql import functions as F

from sensorweave.operators import readings
from sensorweave.schemas import SENSOR_DATA
from sensorweave.sources import jdbc, tables

DAY = dt.timedelta(days=1)


@pytest.fixture
def stored(spark, tmp_path):
    """Five days of hourly readings as a stored table."""
    path = str(tmp_path / "table")
    df = spark.range(120).select(
        F.timestamp_micros(F.lit(1709251200000000) + F.col("id") * 3600 * 1000000).alias("time"),
        F.lit("sensor-1").alias("sensor_id"),
        F.col("id").cast("double").alias("temperature"),
        F.lit(50.0).alias("humidity"),
    )
    tables.write_sorted(df, path)
    return path


def scan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filter_skips_days_and_row_groups(spark, stored):
    df = readings.range_scan(tables.read_table(spark, stored), dt.datetime(2024, 3, 2), dt.datetime(2024, 3, 2, 12))
    assert df.count() == 13
    plan = scan_of(df)
    assert "PartitionFilters: [isnotnull(date" in plan and "date#" in plan
    assert "GreaterThanOrEqual(time" in plan and "LessThanOrEqual(time" in plan
    assert "sensor_id" not in plan.split("ReadSchema")[1]


def test_relative_filter_skips_days(spark, stored):
    df = readings.recent_count(tables.read_table(spark, stored))
    assert df.first()[0] == 1
    assert "GreaterThan(time" in scan_of(df) and ">= 2024-03-05" in scan_of(df)


def test_newest_reads_only_the_days_it_needs(spark, stored):
    df = readings.newest(tables.read_table(spark, stored), 30)
    assert sorted(r.temperature for r in df.collect()) == [float(n) for n in range(90, 120)]
    assert ">= 2024-03-04" in scan_of(df)


def test_busy_day_is_written_by_several_tasks(spark, tmp_path):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        path = str(tmp_path / "busy")
        df = spark.range(4000).select(F.timestamp_micros(F.lit(1709251200000000)).alias("time"), "id")
        tables.write_sorted(df, path)
        assert tables.table_size(spark, path).first().files > 1
        assert tables.read_table(spark, path).count() == 4000
    finally:
        spark.conf.set(name, "true")


def test_append_creates_and_extends(spark, tmp_path, make_readings):
    path = str(tmp_path / "appended")
    tables.append(make_readings((0, 1.0, 1.0)), path)
    tables.append(make_readings((1, 2.0, 2.0), (86400, 3.0, 3.0)), path)
    assert tables.read_table(spark, path).count() == 3
    assert tables.stored_days(spark, path) == [T0.date(), (T0 + DAY).date()]


def test_create_table_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "created")
    tables.create_table(spark, path, SENSOR_DATA)
    assert tables.read_table(spark, path, SENSOR_DATA).count() == 0
    row = spark.sql("SELECT timestamp'2024-01-01' AS time, 's' AS sensor_id")
    tables.append(row, path)
    tables.create_table(spark, path, SENSOR_DATA)
    assert tables.read_table(spark, path, SENSOR_DATA).count() == 1


def test_retention(spark, stored):
    as_of = dt.datetime(2024, 3, 5, 23)
    kept = tables.retained(tables.read_table(spark, stored), 2, as_of)
    assert kept.count() == 49
    assert tables.drop_expired(spark, stored, as_of, 2) == [dt.date(2024, 3, 1), dt.date(2024, 3, 2)]
    assert tables.read_table(spark, stored).count() == 72


def test_batches_replace_themselves_and_compact(spark, tmp_path, make_readings):
    source, target = str(tmp_path / "batches"), str(tmp_path / "compacted")
    for batch_id in (0, 1, 1):
        df = tables.with_date(make_readings((batch_id, 1.0, 1.0), (batch_id + 86400, 2.0, 2.0)))
        tables.overwrite_batch(df, source, batch_id, "date")
    assert tables.read_table(spark, source).count() == 4
    tables.compact(spark, source, target)
    tables.compact(spark, source, target)
    got = tables.read_table(spark, target)
    assert got.count() == 4 and "batch_id" not in got.columns
    # Late rows of the same days join what is there.
    tables.overwrite_batch(tables.with_date(make_readings((7, 3.0, 3.0))), source, 2, "date")
    assert tables.read_compacted(spark, source, target).count() == 5
    tables.compact(spark, source, target)
    assert tables.read_table(spark, target).count() == 5
    assert tables.batch_folders(spark, source) == {}
    assert tables.read_compacted(spark, source, target).count() == 5


@pytest.mark.parametrize("step", ["staging", "replacing", "deleting"])
def test_a_crash_during_compaction_loses_nothing(spark, tmp_path, make_readings, monkeypatch, step):
    source, target = str(tmp_path / "batches"), str(tmp_path / "compacted")
    tables.overwrite_batch(tables.with_date(make_readings((0, 1.0, 1.0))), source, 0, "date")
    tables.compact(spark, source, target)
    tables.overwrite_batch(tables.with_date(make_readings((1, 2.0, 2.0), (86400, 2.0, 2.0))), source, 1, "date")

    def crash(*_args, **_options):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if step == "staging":
            patch.setattr(tables, "_finish", crash)
        elif step == "replacing":
            patch.setattr(tables, "write_sorted", crash)
        else:
            patch.setattr(tables, "batch_folders", lambda *a, real=tables.batch_folders, seen=[]: crash() if seen else seen.append(1) or real(*a))
        with pytest.raises(KeyboardInterrupt):
            tables.compact(spark, source, target)
    tables.compact(spark, source, target)
    assert sorted(r.temperature for r in tables.read_table(spark, target).collect()) == [1.0, 2.0, 2.0]
    assert tables.batch_folders(spark, source) == {}


@pytest.mark.parametrize(
    ("size", "text"),
    [(0, "0 bytes"), (10239, "10239 bytes"), (10240, "10 kB"), (10 * 1024 * 1024, "10 MB"), (3 * 1024**4, "3072 GB")],
)
def test_pretty_size(spark, size, text):
    assert spark.range(1).select(tables.pretty_size(F.lit(size).cast("long"))).first()[0] == text


def test_table_size_lists_all_files(spark, stored):
    row = tables.table_size(spark, stored).first()
    assert row.files >= 5 and row.total_bytes > 0 and row.total_table_size.endswith(("bytes", "kB"))


def test_replayed_batch_adds_only_what_is_missing(spark, tmp_path):
    """The JDBC sink's rule, with a Parquet table standing in for the database."""
    path = str(tmp_path / "store")
    schema = "kafka_partition int, kafka_offset long, batch_id string"
    spark.createDataFrame([], schema).write.parquet(path)

    def sink():
        return jdbc.ReplaySafeAppend(
            lambda batch_id: spark.read.schema(schema).parquet(path).where(F.col("batch_id") == str(batch_id)),
            lambda rows: rows.write.mode("append").parquet(path),
        )

    batch = spark.createDataFrame([(0, 1), (0, 2), (1, 1)], "kafka_partition int, kafka_offset long")
    first = sink()
    first(batch.limit(2), 5)  # an attempt that stored a part
    sink()(batch, 5)  # the restart repeats the batch
    first(batch, 6)
    stored = spark.read.parquet(path)
    assert stored.where("batch_id = '5'").count() == 3
    assert stored.where("batch_id = '6'").count() == 3


def test_batch_of_many_days_has_about_a_file_per_day(spark, make_readings, tmp_path):
    """Not one per day and task."""
    rows = tables.with_date(make_readings(*[(i * 8640, float(i), 1.0) for i in range(100)])).repartition(16)
    path = str(tmp_path / "batches")
    tables.overwrite_batch(rows, path, 0, "date")
    assert len(list((tmp_path / "batches").rglob("*.parquet"))) <= 10 + 4
    assert spark.read.parquet(path).agg({"temperature": "sum", "humidity": "sum"}).first().asDict() == {"sum(temperature)": 4950.0, "sum(humidity)": 100.0}
