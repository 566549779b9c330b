import datetime as dt

import pytest
from instants import T0
from pyspark.sql import functions as F

from sensorweave.operators import latency
from sensorweave.plans import store
from sensorweave.plans.views import group_stats_sql, register_views
from sensorweave.schemas import ALL_METRICS, STAGE_LABELS
from sensorweave.sources import tables


@pytest.fixture(scope="module")
def views(spark, sf_dir):
    tables = [f(spark, sf_dir) for f in (store.sensor_data, store.pipeline_kpi, store.processing_metrics)]
    register_views(spark, *tables)
    return tables


def test_views_answer_sql(spark, views):
    readings = views[0]
    assert spark.sql("SELECT count(*) FROM sensor_data").first()[0] == readings.count()
    assert spark.sql("SELECT count(*) FROM pipeline_latency").first()[0] == readings.dropna(subset=["mqtt_receive_time"]).count()
    assert spark.sql("SELECT count(DISTINCT sensor_id) FROM hourly_avg_humidity").first()[0] == 5
    assert spark.sql("SELECT count(*) FROM pipeline_kpi_stats WHERE pct_change IS NULL").first()[0] == 4
    stages = [r.stage for r in spark.sql("SELECT stage FROM pipeline_latency_stats").collect()]
    assert stages == list(STAGE_LABELS.values())
    assert spark.sql("SELECT max(sample_size) FROM processing_metrics").first()[0] == 100


@pytest.mark.parametrize("width", ["10 seconds", "30 seconds", "1 minute", "15 minutes", "1 hour"])
def test_time_bucket_equals_window(spark, views, width):
    got = spark.sql(f"SELECT time_bucket('{width}', time) AS b, count(*) AS n FROM sensor_data GROUP BY 1")
    expected = views[0].groupBy(F.window("time", width).start.cast("timestamp").alias("b")).agg(F.count("*").alias("n"))
    assert sorted(got.collect()) == sorted(expected.collect())


def test_kpi_function_equals_operator(spark, views):
    as_of = views[0].agg(F.max("time")).first()[0]
    expected = latency.kpi_calculation(views[0], as_of, dt.timedelta(minutes=3))
    got = spark.sql(
        f"SELECT * FROM calculate_pipeline_kpis(INTERVAL '3' MINUTE, TIMESTAMP'{as_of.isoformat(sep=' ')}') ORDER BY time"
    )
    assert got.columns == expected.columns

    def rounded(df):
        return [tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in df.collect()]

    assert rounded(got) == rounded(expected)


def test_kpi_function_counts_back_from_now(spark, views):
    assert spark.sql("SELECT * FROM calculate_pipeline_kpis()").count() == 0


# --- tables given by path ------------------------------------------------------

@pytest.fixture
def live(spark, tmp_path, make_kpi, stamped_readings):
    """Views over two stored day tables, and a function that appends to them."""
    paths = {"sensor_data": str(tmp_path / "sensor_data"), "pipeline_kpi": str(tmp_path / "pipeline_kpi")}

    def append(day, value):
        tables.append(stamped_readings(day * 86400, value), paths["sensor_data"])
        tables.append(make_kpi(*[(day * 86400, metric, value) for metric in ALL_METRICS]), paths["pipeline_kpi"])

    append(0, 100.0)
    register_views(spark, paths["sensor_data"], paths["pipeline_kpi"])
    return append


@pytest.fixture
def stamped_readings(make_readings):
    def make(second, delay):
        rows = make_readings((second, 20.0, 50.0))
        end = latency.epoch_seconds(rows)
        stamps = {"mqtt_receive_time": 3, "kafka_send_time": 2, "spark_receive_time": 1}
        return rows.select("*", *[(end - F.lit(delay * n / 1000)).alias(name) for name, n in stamps.items()])

    return make


def stats_at(spark, moment, interval="INTERVAL '2' MINUTE"):
    return spark.sql(f"SELECT * FROM get_pipeline_latency_stats({interval}, TIMESTAMP_NTZ'{moment.isoformat(sep=' ')}')")


def test_functions_and_views_see_appended_rows(spark, live):
    later = T0 + dt.timedelta(days=1)
    assert {r.avg_ms for r in stats_at(spark, later).collect()} == {None}
    live(1, 300.0)
    assert {r.p99_ms for r in stats_at(spark, later).collect()} == {300.0}
    assert {r.avg_ms for r in stats_at(spark, later, "INTERVAL '3' DAY").collect()} == {200.0}
    assert {r.avg_ms for r in spark.table("pipeline_latency_stats").collect()} == {300.0}  # the newest two minutes
    assert spark.table("pipeline_latency").count() == spark.table("hourly_avg_humidity").count() == 2
    got = spark.sql(f"SELECT * FROM calculate_pipeline_kpis(INTERVAL '3' DAY, TIMESTAMP_NTZ'{later.isoformat(sep=' ')}')")
    assert sorted(round(r.total_latency_ms, 3) for r in got.collect()) == [300.0, 900.0]


def test_functions_end_at_their_moment(spark, live):
    live(1, 300.0)
    got = stats_at(spark, T0 + dt.timedelta(hours=1), "INTERVAL '2' DAY")
    assert {r.max_ms for r in got.collect()} == {100.0}


def test_function_reads_the_days_of_its_window_only(spark, live):
    for day in range(1, 6):
        live(day, 100.0)
    for name, query in {
        "pipeline_kpi": f"get_pipeline_latency_stats(INTERVAL '2' MINUTE, TIMESTAMP_NTZ'{(T0 + dt.timedelta(days=5)).isoformat(sep=' ')}')",
        "pipeline_latency": f"calculate_pipeline_kpis(INTERVAL '2' MINUTE, TIMESTAMP_NTZ'{(T0 + dt.timedelta(days=5)).isoformat(sep=' ')}')",
    }.items():
        execution = spark.sql(f"SELECT * FROM {query}")._jdf.queryExecution()
        plan = spark._jvm.PythonSQLUtils.explainString(execution, "formatted")
        assert "PartitionFilters: [isnotnull(date" in plan and "LessThanOrEqual(time" in plan, name
        assert "Percentile" not in plan and "percentile" not in plan


VALUES = [3.0, -0.0, 0.0, float("inf"), float("-inf"), float("nan"), None, 5e-324, -7.25, 1e300, 1e-300, 3.0000000000000004]


@pytest.mark.parametrize("kept", [12, 7, 3, 1])
def test_sql_statistics_equal_the_built_in_percentile(spark, kept):
    rows = [(f"k{i % 3}", v) for n in range(5) for i, v in enumerate(VALUES[n % 4 : n % 4 + kept] * 3)] + [("empty", None)]
    spark.createDataFrame(rows, "k string, v double").createOrReplaceTempView("statistics_rows")
    quantiles = {"median": 0.5, "p95": 0.95}
    got = spark.sql(group_stats_sql("SELECT k, v FROM statistics_rows", ["k"], "v", quantiles))
    expected = spark.sql(
        "SELECT k, avg(v) AS a, min(v) AS l, max(v) AS h, count(*) AS n, percentile(v, 0.5) AS m, percentile(v, 0.95) AS p "
        "FROM statistics_rows GROUP BY k"
    )

    def text(df):
        return sorted([str(v + 0.0) if isinstance(v, float) else str(v) for v in row] for row in df.collect())

    assert text(got) == text(expected)
