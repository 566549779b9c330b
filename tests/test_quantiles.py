"""Quantiles by digits against the built-in, special numbers included."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from sensorweave.operators.quantiles import group_stats, with_code
from sensorweave.session import application_folder, list_folders, path_exists

WANTED = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
INF, NAN = math.inf, math.nan


def any_double(pick: random.Random) -> float:
    """Any bits: also tiny, huge and negative numbers."""
    value = struct.unpack("<d", pick.getrandbits(64).to_bytes(8, "little"))[0]
    return 0.0 if math.isnan(value) else value


def special(pick):
    return [0.0, -0.0, INF, -INF, NAN, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308] + [
        sign * 2.0**e * near for e in range(-1021, 1023, 97) for sign in (1, -1) for near in (1.0, 1 - 2**-53, 1 + 2**-52)
    ]


def test_codes_have_the_order_of_the_numbers(spark):
    pick = random.Random(3)
    numbers = special(pick) + [any_double(pick) for _ in range(4000)]
    rows = with_code(spark.createDataFrame([(x,) for x in numbers] + [(None,)], "x double"), "x").collect()
    known = [(r.x, r["_code"]) for r in rows if r.x is not None and not math.isnan(r.x)]
    codes = {}
    for x, code in known:
        assert codes.setdefault(x, code) == code  # -0.0 and 0.0 are the same key here
    ordered = sorted(codes.items())
    assert all(a < b for (_, a), (_, b) in zip(ordered, ordered[1:]))
    for x, code in known:
        bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        assert code == (-bits if x < 0 else bits)
    nan, missing = (next(r["_code"] for r in rows if r.x is not None and math.isnan(r.x)), next(r["_code"] for r in rows if r.x is None))
    assert max(code for _, code in known) < nan < missing


def groups(seed):
    pick = random.Random(seed)
    rows = [("one", 4.5), ("nulls", None), ("nulls", None), ("zeros", -0.0), ("zeros", 0.0), ("ties", None)]
    rows += [("ties", 7.25)] * 500 + [("near", 1000 + i * 2.0**-42) for i in range(300)]
    rows += [("wide", any_double(pick) / 1e10) for _ in range(300)]
    rows += [("hot", round(pick.gauss(200, 50), 2)) for _ in range(3000)] + [("nan", x) for x in (NAN, 1.0, 2.0, NAN, -INF, INF)]
    return rows + [(None, 1.0), (None, 3.0)]


def plain(rows):
    def value(v):
        return None if v is None else "nan" if isinstance(v, float) and math.isnan(v) else float(f"{v:.10g}") if isinstance(v, float) else v

    return {r[0]: [value(v) for v in r[1:]] for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_equal_the_builtin(spark, seed):
    rows = [r for r in groups(seed) if r[0] is not None]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    found = plain(group_stats(df, ["g"], "x", WANTED, counted=True).collect())
    expected = plain(group_stats(df, ["g"], "x", WANTED, counted=True, small_groups=True).collect())
    assert found.keys() == expected.keys()
    for name in found:
        if name != "nan":
            assert found[name] == expected[name], name
    assert found["nan"][-5:] == [-INF, 2.0, "nan", "nan", "nan"] or found["nan"][-5] == -INF


def test_quantiles_without_groups_and_without_rows(spark):
    df = spark.createDataFrame([(x,) for _, x in groups(5) if x is None or math.isfinite(x)], "x double")
    found = group_stats(df, [], "x", WANTED, counted=True)
    assert plain([("all", *found.first())]) == plain([("all", *group_stats(df, [], "x", WANTED, counted=True, small_groups=True).first())])
    for empty in (df.limit(0), df.where(F.col("x").isNull())):
        row = group_stats(empty, [], "x", {"p95": 0.95}, counted=True).collect()
        assert [tuple(r) for r in row] == [(None, None, None, empty.count(), None)]
    assert group_stats(df.withColumn("g", F.lit(1)).limit(0), ["g"], "x", WANTED).collect() == []


def test_quantiles_start_no_job_and_leave_no_copy(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "g string, x double")
    before = list_folders(spark, application_folder(spark)) if path_exists(spark, application_folder(spark)) else []
    spark.sparkContext.setJobGroup("quantiles-plan", "plan only")
    built = group_stats(df, ["g"], "x", WANTED)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("quantiles-plan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert built.count() == 2
    after = list_folders(spark, application_folder(spark)) if path_exists(spark, application_folder(spark)) else []
    assert sorted(before) == sorted(after)
