"""Group statistics with exact interpolated quantiles, safe for huge groups.

The built-in ``percentile`` keeps every distinct value of a group in one task.
Here the value of a rank is selected by its digits: numbers are mapped to integers of
the same order and counted by their leading bits; only numbers that share these with a
wanted rank are counted by all their bits. Only counts are shuffled and sorted, so one
group may hold any share of the rows. A caller that knows every group to be small may
ask for the built-in instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits cut off the codes for the first count: sign, exponent and 14 digits of the fraction stay.
#: A task then holds the prefixes of one group, or its different values of one prefix.
SHIFT = 38
#: Codes of infinity, of NaN and of a missing value, which come after all others.
INFINITE = 2047 * 2**52


def _basic(value: str, counted: bool) -> list[Column]:
    stats = [F.avg(value).alias("avg_ms"), F.min(value).alias("min_ms"), F.max(value).alias("max_ms")]
    return stats + ([F.count(F.lit(1)).alias("sample_count")] if counted else [])


def group_stats(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    counted: bool = False,
    small_groups: bool = False,
    approximate: int | None = None,
) -> DataFrame:
    """avg/min/max (and count) of ``value`` per group plus the named quantiles.

    ``approximate`` trades exactness for one mergeable sketch of that accuracy.
    """
    keys = list(keys)
    df = df.select(*keys, value)
    probabilities = [float(p) for p in quantiles.values()]
    if approximate is not None:
        sketch = F.percentile_approx(value, probabilities, approximate)
        return _unpack(df.groupBy(*keys).agg(*_basic(value, counted), sketch.alias("_q")), quantiles)
    if small_groups:
        exact = F.percentile(value, probabilities)
        return _unpack(df.groupBy(*keys).agg(*_basic(value, counted), exact.alias("_q")), quantiles)
    selected = _selected(df, keys, value, quantiles)
    if not keys:
        # One row also where there are no rows at all.
        selected = selected.agg(*[F.max(c).alias(c) for c in selected.columns])
        selected = selected.withColumn("sample_count", F.coalesce("sample_count", F.lit(0)))
    return selected if counted else selected.drop("sample_count")


def _unpack(df: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    named = [F.get("_q", F.lit(i)).alias(name) for i, name in enumerate(quantiles)]
    return df.select(*[c for c in df.columns if c != "_q"], *named)


def with_code(df: DataFrame, value: str) -> DataFrame:
    """Adds ``_code``, an integer in the order of Spark's comparisons: -0.0 equals 0.0, NaN comes
    after infinity, a missing value last.

    These are the bits of the number, rebuilt by exact arithmetic: dividing by powers of two
    loses nothing.
    """
    size, usual, guess, exponent = F.abs(value), F.col("_usual"), F.col("_guess"), F.col("_exponent")
    least, endless, two = F.lit(2.0**-1022), F.lit(float("inf")), F.lit(2.0)
    df = df.withColumn("_usual", F.when((size >= least) & (size < endless), size).otherwise(F.lit(1.0)))
    # The logarithm may miss by one beside a power of two.
    exact = guess - (usual < F.pow(two, guess)).cast("long") + (usual >= F.pow(two, guess + 1)).cast("long")
    fraction = ((usual / F.pow(two, exponent) - 1) * F.lit(2.0**52)).cast("long")
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    code = (
        F.when(size.isNull(), F.lit(INFINITE + 2))
        .when(F.isnan(size), F.lit(INFINITE + 1))
        .when(size == endless, F.lit(INFINITE))
        .when(size < least, tiny)
        .otherwise((exponent + 1023) * F.lit(2**52) + fraction)
    )
    signed = F.when(F.col(value) < 0, -code).otherwise(code)
    df = df.withColumn("_guess", F.floor(F.log2("_usual"))).withColumn("_exponent", exact)
    return df.withColumn("_code", signed).drop("_usual", "_guess", "_exponent")


def _selected(df: DataFrame, keys: list[str], value: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Statistics and quantiles per group. The input is read twice: to count prefixes, and to
    count the values of the prefixes that hold a wanted rank."""
    by = keys or ["_all"]
    codes = with_code(df.withColumn(value, F.col(value).cast("double")), value)
    if not keys:
        codes = codes.withColumn("_all", F.col("_code").isNotNull())
    prefix = F.shiftright("_code", SHIFT)

    counts = codes.groupBy(*by, prefix.alias("_prefix")).agg(
        F.count(value).alias("_n"), F.sum(value).alias("_sum"), F.min(value).alias("_low"), F.max(value).alias("_high"), F.count(F.lit(1)).alias("_rows")
    )
    group = Window.partitionBy(*by)
    stats = F.struct(
        F.sum("_n").over(group).alias("n"),
        F.sum("_sum").over(group).alias("sum"),
        F.min("_low").over(group).alias("low"),
        F.max("_high").over(group).alias("high"),
        F.sum("_rows").over(group).alias("rows"),
    )
    at = [F.lit(float(p)) * (F.col("_stats.n") - 1) for p in quantiles.values()]
    ranks = F.array(*[side(rank) for rank in at for side in (F.floor, F.ceil)])
    until = F.sum("_n").over(group.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.select(*by, F.col("_prefix").alias("_near"), "_n", (until - F.col("_n")).alias("_first"), stats.alias("_stats"))
    # A group without values has ranks nowhere; its missing values stand for them.
    here = F.exists(ranks, lambda rank: (rank >= F.col("_first")) & (rank < F.col("_first") + F.col("_n")))
    near = placed.where(here | (F.col("_stats.n") == 0)).drop("_n")

    rows = codes.withColumn("_near", prefix).join(near, [*by, "_near"])
    values = rows.groupBy(*by, "_near", "_code").agg(
        F.count(value).alias("_n"), F.min(value).alias("_value"), F.any_value("_first").alias("_first"), F.any_value("_stats").alias("_stats")
    )
    inside = Window.partitionBy(*by, "_near").orderBy("_code").rowsBetween(Window.unboundedPreceding, 0)
    values = values.withColumn("_until", F.col("_first") + F.sum("_n").over(inside)).withColumn("_from", F.col("_until") - F.col("_n"))

    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_until")), F.col("_value")))

    sides = [value_at(side(rank)).alias(f"_{name}_{side.__name__}") for name, rank in zip(quantiles, at, strict=True) for side in (F.floor, F.ceil)]
    found = values.groupBy(*by).agg(F.any_value("_stats").alias("_stats"), *sides)
    results = []
    for name, rank in zip(quantiles, at, strict=True):
        low, high, part = F.col(f"_{name}_floor"), F.col(f"_{name}_ceil"), rank - F.floor(rank)
        results.append(F.when(low == high, low).otherwise((F.lit(1.0) - part) * low + part * high).alias(name))
    return found.select(
        *keys,
        F.try_divide("_stats.sum", "_stats.n").alias("avg_ms"),
        F.col("_stats.low").alias("min_ms"),
        F.col("_stats.high").alias("max_ms"),
        F.col("_stats.rows").alias("sample_count"),
        *results,
    )
