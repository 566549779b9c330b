"""Alert states kept across micro-batches: pending, firing, resolved.

A rule judges closed minutes one after the other by what the stream has stored of them.
A bad minute makes the rule pending, ``hold`` bad minutes in a row make it fire, and the
next good one resolves it (or makes it inactive, if it had not fired). Minutes without a message
are judged too: every batch judges up to the watermark, and ``tick`` judges by the clock,
so that silence needs no message to be noticed.

What is stored per judgement are the changes and, written last, one row per rule with the
minute reached and the bad minutes in a row. A judgement that was cut off is repeated under
the same number; one that reaches no new minute does nothing, so a repeated batch changes
nothing. Rows that arrive for a judged minute do not change it.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorweave.config import IngestConfig
from sensorweave.functions.timing import DATE, instant_to_ntz, time_bucket, with_date
from sensorweave.operators.rollups import MINUTE, floor_to
from sensorweave.schemas import THROUGHPUT_ALERT_PER_MINUTE
from sensorweave.session import path_exists
from sensorweave.sources.tables import batch_folders, drop_batch, overwrite_batch, read_table
from sensorweave.streaming.aggregates import stream_rollup
from sensorweave.streaming.fanout import DEAD_LETTERS, read_output

CHANGES = "alert_changes"
STATE = "alert_state"
THROUGHPUT, ERRORS = "throughput", "errors"
PENDING, FIRING, RESOLVED, INACTIVE = "pending", "firing", "resolved", "inactive"

CHANGE_COLUMNS = "rule string, minute timestamp_ntz, state string, value long, date date, batch_id long"
STATE_COLUMNS = "rule string, minute timestamp_ntz, bad long, batch_id long"


@dataclass(frozen=True)
class Rule:
    """``name`` is bad in a minute whose count is below ``threshold``, or not below it with ``above``."""

    name: str
    threshold: int
    hold: int = 1
    above: bool = False

    def bad(self, value: Column) -> Column:
        return value >= self.threshold if self.above else value < self.threshold


DEFAULT_RULES = (Rule(THROUGHPUT, THROUGHPUT_ALERT_PER_MINUTE, hold=2), Rule(ERRORS, 1, above=True))


def changes(counts: DataFrame, rules: Sequence[Rule], first: dt.datetime, end: dt.datetime, open_runs: dict[str, int]) -> DataFrame:
    """All minutes ``first <= minute < end`` of every rule with their value, the bad minutes in a row
    up to them, and the state they change to, if they change it.

    ``counts`` has rule, minute and value; a minute it lacks counts 0. ``open_runs`` are the bad
    minutes in a row before ``first``. One row per rule and minute is left here, however many readings there are.
    """
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))
    start = F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz")
    told = F.explode(
        F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.hold).alias("hold"), F.lit(open_runs.get(r.name, 0)).alias("open")) for r in rules])
    )
    spine = counts.sparkSession.range((end - first) // MINUTE).select((start + step).alias("minute"), told.alias("_r")).select("minute", "_r.*")
    rows = spine.join(counts, ["rule", "minute"], "left").withColumn("value", F.coalesce("value", F.lit(0)).cast("long"))
    verdict = F.lit(False)
    for rule in rules:
        verdict = F.when(F.col("rule") == rule.name, rule.bad(F.col("value"))).otherwise(verdict)
    rows = rows.withColumn("is_bad", verdict)

    series = Window.partitionBy("rule").orderBy("minute")
    good_so_far = F.sum((~F.col("is_bad")).cast("long")).over(series)
    rows = rows.withColumn("run", good_so_far)
    in_run = F.sum(F.col("is_bad").cast("long")).over(Window.partitionBy("rule", "run").orderBy("minute"))
    # The first run goes on with what was open before.
    rows = rows.withColumn("bad", F.when(~F.col("is_bad"), F.lit(0)).otherwise(in_run + F.when(F.col("run") == 0, F.col("open")).otherwise(0)))
    before = F.coalesce(F.lag("bad").over(series), F.col("open"))
    bad, hold = F.col("bad"), F.col("hold")
    state = (
        F.when(F.col("is_bad") & (bad == hold), FIRING)
        .when(F.col("is_bad") & (bad == 1), PENDING)
        .when(~F.col("is_bad") & (before >= hold), RESOLVED)
        .when(~F.col("is_bad") & (before > 0), INACTIVE)
    )
    return rows.select("rule", "minute", "value", bad.cast("long").alias("bad"), state.alias("state"))


class AlertBook:
    """Judges the rules over the tables of the ingest job."""

    def __init__(self, config: IngestConfig, rules: Sequence[Rule] = DEFAULT_RULES, lateness: dt.timedelta = 10 * MINUTE):
        self._config, self._rules, self._lateness = config, tuple(rules), lateness
        # A batch and the clock may judge at the same time.
        self._lock = threading.Lock()
        self._ticked: dt.datetime | None = None

    def _counts(self, spark: SparkSession, first: dt.datetime | None, end: dt.datetime) -> DataFrame:
        """Readings per minute from the minute partials, dead letters per minute of arrival; the days outside stay closed."""
        minutes = stream_rollup(self._config).read(spark, "minute")
        dead = read_output(spark, self._config, DEAD_LETTERS)

        def within(rows: DataFrame) -> DataFrame:
            rows = rows.where(F.col(DATE) <= F.lit(end.date())).withColumn("minute", instant_to_ntz("minute"))
            rows = rows.where(F.col("minute") < F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz"))
            if first is None:
                return rows
            return rows.where((F.col(DATE) >= F.lit(first.date())) & (F.col("minute") >= F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz")))

        read = within(minutes.select(F.col("time").alias("minute"), "n", DATE)).groupBy("minute").agg(F.sum("n").alias("value"))
        lost = within(dead.select(time_bucket("1 minute").alias("minute"), DATE)).groupBy("minute").agg(F.count(F.lit(1)).alias("value"))
        return read.select(F.lit(THROUGHPUT).alias("rule"), "*").unionByName(lost.select(F.lit(ERRORS).alias("rule"), "*"))

    def _state(self, spark: SparkSession) -> tuple[int, dict[str, tuple[dt.datetime, int]]]:
        """Number of the last judgement, and per rule the minute after it and the bad minutes in a row."""
        path = self._config.table(STATE)
        numbers = batch_folders(spark, path)
        if not numbers:
            return -1, {}
        last = max(numbers)
        rows = read_table(spark, path).where(F.col("batch_id") == last).collect()  # one row per rule
        return last, {row["rule"]: (row["minute"], row["bad"]) for row in rows}

    def judge(self, spark: SparkSession, until: dt.datetime) -> None:
        """Judges the minutes that end by ``until`` (UTC) and were not judged before."""
        with self._lock:
            self._judge(spark, floor_to(until, MINUTE))

    def _judge(self, spark: SparkSession, end: dt.datetime) -> None:
        if not batch_folders(spark, stream_rollup(self._config).fresh("minute")):
            return
        last, state = self._state(spark)
        first = max((minute for minute, _ in state.values()), default=None)
        counts = self._counts(spark, first, end)
        if first is None:
            first = counts.agg(F.min("minute")).first()[0]
        if first is None or first >= end:
            return
        number = last + 1
        judged = changes(counts, self._rules, first, end, {name: bad for name, (_, bad) in state.items()}).persist()
        try:
            drop_batch(spark, self._config.table(CHANGES), number)
            changed = with_date(judged.where(F.col("state").isNotNull()).select("rule", "minute", "state", "value"), "minute")
            overwrite_batch(changed, self._config.table(CHANGES), number, DATE)
            reached = F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz")
            stand = judged.groupBy("rule").agg(F.max_by("bad", "minute").alias("bad")).select("rule", reached.alias("minute"), "bad")
            overwrite_batch(stand.coalesce(1), self._config.table(STATE), number)
        finally:
            judged.unpersist()

    def tick(self, spark: SparkSession, now: dt.datetime | None = None) -> None:
        """Judges by the clock, once a minute at most: minutes older than the lateness, silent or not."""
        now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        minute = floor_to(now - self._lateness, MINUTE)
        if minute != self._ticked:
            self.judge(spark, minute)
            self._ticked = minute


def read_changes(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """Changes of complete judgements."""
    rows = spark.read.schema(CHANGE_COLUMNS)
    if not path_exists(spark, config.table(CHANGES)):
        return spark.createDataFrame([], CHANGE_COLUMNS)
    last = max(batch_folders(spark, config.table(STATE)), default=-1)
    return rows.parquet(config.table(CHANGES)).where(F.col("batch_id") <= last)


def current_states(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """The last change of every rule that ever changed."""
    newest = F.max_by(F.struct("minute", "state", "value"), "minute").alias("newest")
    return read_changes(spark, config).groupBy("rule").agg(newest).select("rule", "newest.*")
