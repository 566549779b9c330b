"""What the plans of the registered queries must and must not contain."""

import re

import __spark_entry__ as entry
import pytest

QUERIES = entry.queries()
# The corpus operators' queries run jobs of their own and have their own tests.
BATCH = sorted(name for name in QUERIES if not re.match(r"stream_|op\d+_|pipeline$", name))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan


@pytest.mark.parametrize("name", BATCH)
def test_whole_table_goes_through_no_single_task(spark, sf_dir, name):
    """One-task exchanges follow partial aggregates or number a list of partitions."""
    plan = plan_of(QUERIES[name](spark, sf_dir))
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1]
            assert re.search(r"partial_|HashAggregate\(keys=\[_part", below), f"{line}\n{below}"


COLUMNS = {
    "total_measurements": {"time", "date"},
    "hourly_avg_temperature": {"time", "sensor_id", "temperature", "date"},
    "hist_humidity": {"time", "humidity", "date"},
    "latest_reading": {"time", "sensor_id", "temperature", "humidity", "date"},
    "kpi_total_avg": {"time", "metric_name", "value_ms", "date"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_scan_reads_only_needed_columns(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    read = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert {c.split("#")[0] for c in read.split(",")} == COLUMNS[name]


def test_messages_are_parsed_once(spark, sf_dir):
    assert plan_of(QUERIES["parse_readings"](spark, sf_dir)).count("from_json(") == 1


def test_top_rows_use_a_partial_sort(spark, sf_dir):
    for name in ("extreme_values", "latest_reading", "latest_readings", "latest_kpi", "hist_temperature"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["recent_count", "trend_15m", "latency_e2e_30s", "kpi_total_avg"])
def test_relative_windows_prune_days_and_push_time_down(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert re.search(r"PartitionFilters: \[[^\]]*date#", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(time", plan)
    assert re.search(r"time#\d+ <= ", plan)
