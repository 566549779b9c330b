"""Bins, bands and null-safe arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def equal_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """1-based equal-width bin; ``high`` itself falls into bin ``bins + 1``."""
    return (F.floor((value - F.lit(low)) / F.lit((high - low) / bins)) + 1).cast("long")


def unit_cell(value: Column) -> Column:
    return F.floor(value).cast("long")


def width_bin(value: Column, width: float) -> Column:
    """Lower edge of the fixed-width bin that holds ``value``."""
    return F.floor(value / F.lit(width)) * F.lit(width)


def outside(value: Column, low: float, high: float) -> Column:
    return (value < F.lit(low)) | (value > F.lit(high))


def band(value: Column, steps: Sequence[tuple[float, str]], base: str) -> Column:
    """Label of the highest step that ``value`` reaches; NULL has no band."""
    labelled = F.when(value.isNull(), F.lit(None).cast("string"))
    for threshold, label in sorted(steps, reverse=True):
        labelled = labelled.when(value >= F.lit(threshold), F.lit(label))
    return labelled.otherwise(F.lit(base))


def percent_change(current: Column, previous: Column) -> Column:
    return F.lit(100.0) * (current - previous) / F.nullif(previous, F.lit(0.0))


def rounded(value: Column, places: int = 6) -> Column:
    """Rounded value without a negative zero."""
    return F.round(value, places) + F.lit(0.0)
