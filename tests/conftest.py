from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from instants import T0  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sensorweave.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR



@pytest.fixture
def make_readings(spark):
    """Readings from (seconds after T0, temperature, humidity[, sensor]) tuples."""

    def make(*rows):
        full = [
            (T0 + dt.timedelta(seconds=row[0]), row[3] if len(row) > 3 else "sensor-1", row[1], row[2]) for row in rows
        ]
        return spark.createDataFrame(full, "time timestamp_ntz, sensor_id string, temperature double, humidity double")

    return make


@pytest.fixture
def make_kpi(spark):
    """KPI rows from (seconds after T0, metric, value) tuples."""

    def make(*rows):
        full = [(T0 + dt.timedelta(seconds=s), metric, value, "b", 1, "{}") for s, metric, value in rows]
        schema = "time timestamp_ntz, metric_name string, value_ms double, batch_id string, message_count int, metadata string"
        return spark.createDataFrame(full, schema)

    return make
