"""Streams over recorded messages: completeness, restarts, late and malformed rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sensorweave.config import IngestConfig
from sensorweave.functions import messages as msg
from sensorweave.schemas import ALL_METRICS, KAFKA_RECORD
from sensorweave.sources.jdbc import ReplaySafeAppend
from sensorweave.sources.kafka import record_stream, with_coordinates
from sensorweave.streaming import aggregates, alerts, fanout, ingest, intake, job
from sensorweave.streaming.progress import ProgressTable, progress_row

BASE = 1709294400  # 2024-03-01 12:00:00 UTC


class Topic:
    """A folder of Parquet files shaped like Kafka records."""

    def __init__(self, spark, path):
        self.spark, self.path, self.offset = spark, str(path), 0
        spark.createDataFrame([], KAFKA_RECORD).write.parquet(self.path)

    def send(self, *messages):
        rows = []
        for message in messages:
            text = message if isinstance(message, str) else json.dumps(message)
            arrival = dt.datetime.fromtimestamp(BASE + self.offset)
            rows.append((None, bytearray(text.encode()), "sensor-data", 0, self.offset, arrival, 0))
            self.offset += 1
        self.spark.createDataFrame(rows, KAFKA_RECORD).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self, **options):
        return record_stream(self.spark, self.path, **options)


def reading(second, temperature=20.0, humidity=50.0, **extra):
    return {"temperature": temperature, "humidity": humidity, "timestamp": BASE + second, **extra}


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def config(tmp_path):
    return IngestConfig(table_root=str(tmp_path / "tables"), checkpoint_root=str(tmp_path / "checkpoints"))


def drain(writer, config):
    query = ingest.triggered(writer, config, drain=True).start()
    query.awaitTermination()
    return query


def run_fanout(topic, config, *sinks, **options):
    return drain(fanout.fanout_writer(ingest.parsed_stream(topic.stream(**options), config), config, sinks), config)


def test_fanout_fills_every_table(spark, topic, config):
    topic.send(reading(0, mqtt_receive_time=BASE + 0.5, kafka_send_time=BASE + 0.75), "not json", reading(1, sensor_id="s2"))
    run_fanout(topic, config)
    got = fanout.read_output(spark, config, fanout.READINGS).orderBy("kafka_offset").collect()
    assert [(r.sensor_id, r.kafka_offset, r.temperature) for r in got] == [("sensor-1", 0, 20.0), ("s2", 2, 20.0)]
    assert len({r.spark_receive_time for r in got}) == 1
    assert got[1].kafka_send_time == BASE + 2.0  # the record's own time stands in
    dead = fanout.read_output(spark, config, fanout.DEAD_LETTERS).collect()
    assert [(r.kafka_offset, r.message) for r in dead] == [(1, "not json")]
    kpis = {r.metric_name: r for r in fanout.read_output(spark, config, fanout.KPI).collect()}
    assert set(kpis) == set(ALL_METRICS)
    assert all(r.message_count == 2 for r in kpis.values())
    assert kpis["mqtt_to_kafka"].value_ms == 250.0
    stages = sum(kpis[m].value_ms for m in ALL_METRICS[:3])
    assert kpis["total_pipeline_latency"].value_ms == pytest.approx(stages)
    assert json.loads(kpis["spark_to_timescaledb"].metadata)["avg_temperature"] == 20.0
    metrics = fanout.read_output(spark, config, fanout.METRICS).collect()
    assert [(r.sample_size, r.avg_processing_time == r.processing_time) for r in metrics] == [(1, True)]


def test_batch_without_valid_messages(spark, topic, config):
    topic.send("not json", "{}")
    seen = []
    run_fanout(topic, config, lambda rows, batch_id: seen.append(batch_id))
    assert seen == []
    assert fanout.read_output(spark, config, fanout.READINGS).count() == 0
    assert fanout.read_output(spark, config, fanout.DEAD_LETTERS).count() == 2
    row = fanout.read_output(spark, config, fanout.KPI).where("metric_name = 'spark_to_timescaledb'").first()
    assert row.message_count == 0 and json.loads(row.metadata)["avg_humidity"] == 0


def test_restart_adds_only_new_messages(spark, topic, config):
    topic.send(*[reading(n) for n in range(5)])
    run_fanout(topic, config)
    topic.send(*[reading(n) for n in range(5, 8)])
    run_fanout(topic, config)
    run_fanout(topic, config)
    offsets = [r.kafka_offset for r in fanout.read_output(spark, config, fanout.READINGS).collect()]
    assert sorted(offsets) == list(range(8))
    sizes = [r.sample_size for r in fanout.read_output(spark, config, fanout.METRICS).orderBy("batch_id").collect()]
    assert sizes == [1, 2]


def kept_windows(spark, config):
    rows = intake.minute_windows(spark, config).orderBy("window_start").collect()
    return [(int(r.window_start.timestamp()) - BASE, r.readings_count) for r in rows]


def run_intake(topic, config, *sinks, **options):
    parsed = ingest.parsed_stream(topic.stream(), config)
    return drain(intake.intake_writer(parsed, config, sinks, **options), config)


def batch_rows(spark, config):
    rows = intake.read_intake(spark, config, intake.BATCHES).orderBy("batch_id").collect()
    return [(r.batch_id, r.message_count, r.dead_count, r.late_count) for r in rows]


@pytest.mark.parametrize("merge_every", [0, 1, 2])
def test_intake_keeps_all_tables_over_restarts(spark, topic, config, merge_every):
    minutes = dt.timedelta(minutes=10)
    for messages in (
        (reading(0), reading(3600), "broken"),
        (reading(100, sensor_id="s2"), reading(86400)),
        ("{}", "broken again"),
        (reading(1, temperature=40.0), reading(86400 - 600), reading(86400 - 601)),
    ):
        topic.send(*messages)
        run_intake(topic, config, lateness=minutes, merge_every=merge_every)
    # The watermark of the last batch is 86400 - 600; a batch without readings keeps it.
    assert batch_rows(spark, config) == [(0, 2, 1, 0), (1, 2, 0, 1), (2, 0, 2, 0), (3, 3, 0, 2)]
    late = intake.read_intake(spark, config, intake.LATE).orderBy("batch_id", "kafka_offset").collect()
    assert [(r.batch_id, int(r.time.timestamp()) - BASE) for r in late] == [(1, 100), (3, 1), (3, 85799)]
    for table in (fanout.READINGS, intake.ARCHIVE):
        found = intake.read_intake(spark, config, table).collect()
        assert sorted(r.kafka_offset for r in found) == [0, 1, 3, 4, 7, 8, 9]
    assert sorted(r.kafka_offset for r in intake.read_intake(spark, config, fanout.DEAD_LETTERS).collect()) == [2, 5, 6]
    assert dict(kept_windows(spark, config)) == {0: 2, 60: 1, 3600: 1, 85740: 1, 85800: 1, 86400: 1}
    kpis = intake.read_intake(spark, config, fanout.KPI).groupBy("batch_id").count().collect()
    assert sorted(tuple(r) for r in kpis) == [(n, 4) for n in range(4)]
    metrics = intake.read_intake(spark, config, fanout.METRICS).orderBy("batch_id").collect()
    assert [r.sample_size for r in metrics] == [1, 2, 3, 4]
    times = [r.processing_time for r in metrics]
    assert metrics[-1].median_processing_time == pytest.approx(sorted(times)[1] / 2 + sorted(times)[2] / 2)
    assert metrics[0].stddev_processing_time == 0.0 and metrics[-1].max_processing_time == max(times)


def test_intake_repeats_a_failed_batch_without_a_trace(spark, topic, config):
    topic.send(reading(0), reading(7200), "broken")
    run_intake(topic, config)
    topic.send(reading(10), reading(90000))

    def broken(rows, batch_id):
        raise RuntimeError("sink broken")

    with pytest.raises(Exception, match="sink broken"):
        run_intake(topic, config, broken)
    # The attempt also left rows under a day that the repetition does not write.
    stale = intake.read_intake(spark, config, fanout.READINGS).where("batch_id = 1").limit(1)
    path = f"{config.table(fanout.READINGS)}/date=1999-01-01/batch_id=1"
    stale.drop("date", "batch_id").write.parquet(path)
    run_intake(topic, config)
    assert batch_rows(spark, config) == [(0, 2, 1, 0), (1, 2, 0, 1)]
    assert intake.read_intake(spark, config, fanout.READINGS).count() == 4
    assert dict(kept_windows(spark, config)) == {0: 2, 7200: 1, 90000: 1}


def told(spark, config):
    rows = alerts.read_changes(spark, config).orderBy("rule", "minute").collect()
    start = dt.datetime.fromtimestamp(BASE, dt.timezone.utc).replace(tzinfo=None)
    return [(r.rule, int((r.minute - start) / dt.timedelta(minutes=1)), r.state) for r in rows]


def test_alerts_keep_their_state_over_batches_and_silence(spark, topic, config):
    rules = (alerts.Rule(alerts.THROUGHPUT, 1, hold=3), alerts.Rule(alerts.ERRORS, 1, above=True))
    none = dt.timedelta(0)
    book = lambda: alerts.AlertBook(config, rules, none)
    start = dt.datetime.fromtimestamp(BASE, dt.timezone.utc).replace(tzinfo=None)

    def batch(*messages):
        topic.send(*messages)
        run_intake(topic, config, lateness=none, alerts=book())

    batch("broken", reading(0), reading(60), reading(240))  # minutes 2 and 3 are silent
    assert told(spark, config) == [("errors", 0, "firing"), ("errors", 1, "resolved"), ("throughput", 2, "pending")]
    batch(reading(420))  # 4 has a reading; 5 and 6 are silent
    assert told(spark, config)[3:] == [("throughput", 4, "inactive"), ("throughput", 5, "pending")]
    # No message comes, but the clock goes on: 7 has a reading, from 8 on there is silence.
    again = book()
    for minute in (8, 8, 9, 11, 12):
        again.tick(spark, start + dt.timedelta(minutes=minute, seconds=30))
    assert told(spark, config)[5:] == [("throughput", 7, "inactive"), ("throughput", 8, "pending"), ("throughput", 10, "firing")]
    # A late row changes no judged minute; the next reading resolves.
    batch(reading(485), reading(720), reading(780))
    assert told(spark, config)[8:] == [("throughput", 12, "resolved")]
    before = told(spark, config)
    again.judge(spark, start)
    book().judge(spark, start + dt.timedelta(minutes=13))
    assert told(spark, config) == before
    states = {r.rule: r.state for r in alerts.current_states(spark, config).collect()}
    assert states == {"errors": "resolved", "throughput": "resolved"}


def test_alerts_without_tables_say_nothing(spark, config):
    alerts.AlertBook(config).tick(spark)
    assert alerts.read_changes(spark, config).count() == 0


def test_old_days_are_dropped_from_every_table(spark, topic, config):
    day = 86400
    topic.send(reading(0), reading(5 * day), "broken")
    run_intake(topic, config, merge_every=1)
    topic.send(reading(1), reading(9 * day), reading(5 * day + 1))
    run_intake(topic, config, merge_every=1)
    as_of = dt.datetime.fromtimestamp(BASE + 9 * day, dt.timezone.utc).replace(tzinfo=None)
    dropped = intake.expire_intake(spark, config, as_of, days=7)
    assert [d.isoformat() for d in dropped[fanout.READINGS]] == ["2024-03-01"]
    assert dropped[fanout.DEAD_LETTERS] and not dropped[fanout.KPI]
    left = intake.read_intake(spark, config, fanout.READINGS).orderBy("time").collect()
    assert [int(r.time.timestamp()) - BASE for r in left] == [5 * day, 5 * day + 1, 9 * day]
    assert intake.read_intake(spark, config, fanout.DEAD_LETTERS).count() == 0
    assert intake.read_intake(spark, config, fanout.KPI).count() == 8


def test_tables_are_read_by_day(spark, topic, config):
    topic.send(reading(0), reading(86400), reading(2 * 86400))
    run_intake(topic, config, merge_every=1)
    topic.send(reading(5), reading(86405))
    run_intake(topic, config, merge_every=1)
    rows = intake.read_intake(spark, config, fanout.READINGS).where("date = '2024-03-02'")
    assert rows.count() == 2
    scans = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    assert scans.count("PartitionFilters: [isnotnull(date") == 2  # day files and fresh batches


def test_failed_batch_is_repeated_without_duplicates(spark, topic, config, tmp_path):
    topic.send(*[reading(n) for n in range(4)])
    store = str(tmp_path / "store")
    schema = "kafka_partition int, kafka_offset long, batch_id string"
    spark.createDataFrame([], schema).write.parquet(store)

    def sink(fail):
        def write(rows):
            rows = rows.select("kafka_partition", "kafka_offset", "batch_id")
            (rows.limit(3) if fail else rows).write.mode("append").parquet(store)
            if fail:
                raise RuntimeError("database gone")

        read = lambda batch_id: spark.read.schema(schema).parquet(store).where(F.col("batch_id") == str(batch_id))
        return ReplaySafeAppend(read, write)

    with pytest.raises(Exception, match="database gone"):
        run_fanout(topic, config, sink(fail=True))
    run_fanout(topic, config, sink(fail=False))
    assert sorted(r.kafka_offset for r in spark.read.parquet(store).collect()) == [0, 1, 2, 3]
    assert fanout.read_output(spark, config, fanout.READINGS).count() == 4
    assert fanout.read_output(spark, config, fanout.KPI).count() == 4


def test_archive_survives_restart(spark, topic, config):
    for start in (0, 3):
        topic.send(*[reading(n) for n in range(start, start + 3)], "broken")
        drain(ingest.archive_writer(ingest.parsed_stream(topic.stream(), config), config), config)
    got = spark.read.parquet(config.table("archive"))
    assert sorted(r.timestamp for r in got.collect()) == [BASE + n for n in range(6)]
    assert "date" in got.columns


def test_base64_topic(spark, topic, tmp_path):
    import base64

    config = IngestConfig(str(tmp_path / "t"), str(tmp_path / "c"), codec="base64")
    topic.send(json.dumps(base64.b64encode(json.dumps(reading(0)).encode()).decode()), "plain text")
    run_fanout(topic, config)
    assert fanout.read_output(spark, config, fanout.READINGS).count() == 1
    assert fanout.read_output(spark, config, fanout.DEAD_LETTERS).count() == 1


def test_extreme_readings_pass_live(spark, topic, config):
    topic.send(reading(0), reading(1, temperature=28.5), reading(2, humidity=39.0))
    parsed = ingest.parsed_stream(topic.stream(), config)
    drain(ingest.readings_writer(parsed, config, "extremes", extremes=True), config)
    assert sorted(r.kafka_offset for r in spark.read.parquet(config.table("extremes")).collect()) == [1, 2]


def tumbling(topic, config, **options):
    stream = ingest.reading_stream(ingest.parsed_stream(topic.stream(), config), config)
    return drain(aggregates.tumbling_writer(stream, config, **options), config)


def windows(spark, config):
    rows = aggregates.read_tumbling(spark, config).orderBy("window_start").collect()
    return [(int(r.window_start.timestamp()) - BASE, r.readings_count) for r in rows]


def test_late_rows_inside_and_beyond_the_watermark(spark, topic, config):
    topic.send(reading(0), reading(700))
    tumbling(topic, config, lateness="10 minutes")
    # The watermark is now at second 100: the first is kept, the second is too late.
    topic.send(reading(130), reading(10))
    query = tumbling(topic, config, lateness="10 minutes")
    assert windows(spark, config) == [(0, 1), (120, 1), (660, 1)]
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1


def test_late_rows_count_in_tables_and_hourly_view(spark, topic, config):
    for messages in ((reading(7200, 30.0),), (reading(0, 10.0), reading(1, 20.0)), (reading(3, 30.0),)):
        topic.send(*messages)
        run_fanout(topic, config)
        stream = ingest.reading_stream(ingest.parsed_stream(topic.stream(), config), config)
        drain(aggregates.hourly_writer(stream, config), config)
    got = aggregates.read_hourly(spark, config).orderBy("hour").collect()
    assert [(int(r.hour.timestamp()) - BASE, r.avg_temperature) for r in got] == [(0, 20.0), (7200, 30.0)]
    assert fanout.read_output(spark, config, fanout.READINGS).count() == 4


def test_window_updates_replace_earlier_versions(spark, topic, config):
    for n in range(3):
        topic.send(reading(n), reading(60 + n))
        tumbling(topic, config)
    assert windows(spark, config) == [(0, 3), (60, 3)]


def test_several_batches_equal_the_batch_query(spark, topic, config):
    for start in range(0, 40, 10):
        topic.send(*[reading(n * 9, temperature=15.0 + n, sensor_id=f"s{n % 3}") for n in range(start, start + 10)])
    run_fanout(topic, config, maxFilesPerTrigger=1)
    batches = fanout.read_output(spark, config, fanout.METRICS).count()
    assert batches >= 4
    expected = msg.enrich(msg.parse_messages(with_coordinates(spark.read.parquet(topic.path))), F.lit(0.0))
    columns = ["time", "sensor_id", "temperature", "humidity", "raw_data", "kafka_offset"]
    got = fanout.read_output(spark, config, fanout.READINGS)
    assert sorted(got.select(*columns).collect()) == sorted(expected.select(*columns).collect())


def test_progress_is_stored(spark, topic, config):
    topic.send(*[reading(n) for n in range(6)])
    listener = ProgressTable(spark, config.table("stream_progress"))
    spark.streams.addListener(listener)
    try:
        query = run_fanout(topic, config)
        assert listener.wait_for(query)
    finally:
        spark.streams.removeListener(listener)
    got = listener.read().where("num_input_rows > 0").collect()
    assert [(r.query_name, r.num_input_rows) for r in got] == [("fanout", 6)]
    assert got[0].batch_duration_ms > 0 and "addBatch" in json.loads(got[0].durations_ms)


def test_progress_row_of_a_sparse_report():
    row = progress_row({"id": "i", "runId": "r", "batchId": 3, "timestamp": "t"})
    assert row[:6] == ("i", "r", None, 3, "t", 0) and row[8] == 0


def test_job_runs_all_streams_together(spark, topic, config):
    topic.send(*[reading(n) for n in range(5)], "broken")
    queries = job.start_streams(topic.stream(), config, drain=True)
    job.await_all(queries)
    assert not any(q.isActive for q in queries)
    assert [q.name for q in queries] == ["intake"]
    assert fanout.read_output(spark, config, fanout.READINGS).count() == 5
    assert intake.read_intake(spark, config, intake.ARCHIVE).count() == 5
    assert kept_windows(spark, config) == [(0, 5)]


def test_console_output_is_an_option(topic, config):
    from dataclasses import replace

    topic.send(reading(0))
    queries = job.start_streams(topic.stream(), replace(config, console=True), drain=True)
    assert {"console_raw", "console_parsed"} <= {q.name for q in queries}
    job.await_all(queries)
    shown = {q.name: sum(p["numInputRows"] for p in q.recentProgress) for q in queries}
    assert shown["console_raw"] == shown["console_parsed"] == 1


def test_job_fails_together(spark, topic, config):
    topic.send(reading(0))

    def broken(rows, batch_id):
        raise RuntimeError("sink broken")

    parsed = ingest.parsed_stream(topic.stream(), config)
    endless = ingest.triggered(ingest.archive_writer(parsed, config), config).start()
    failing = ingest.triggered(fanout.fanout_writer(parsed, config, (broken,)), config).start()
    with pytest.raises(Exception, match="sink broken"):
        job.await_all([endless, failing])
    assert not endless.isActive
