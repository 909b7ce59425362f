"""Small guarded numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, 0 where the denominator is 0."""
    return F.when(denominator != 0, numerator.cast("double") / denominator).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def nan_to_null(column: Column) -> Column:
    """NaN counts as missing everywhere here; Spark would treat it as a value."""
    return F.when(~F.isnan(column), column)


def count_where(condition: Column) -> Column:
    """Number of rows meeting the condition, 0 (not NULL) on an empty input."""
    return F.count(F.when(condition, F.lit(1)))


def status(rate: Column) -> Column:
    """Health status of an anomaly rate given in percent."""
    # Limits and labels of the health status.
    return F.when(rate < 1, "NOMINAL").when(rate < 5, "CAUTION").otherwise("ALERT")
