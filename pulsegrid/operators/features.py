"""Features for anomaly detection on gap-free series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from pulsegrid.operators.series import Axis, over_rows, over_rows_filled

# Fixed value: rows per rolling window.
ROLLING_ROWS = 24


def power(df: DataFrame) -> DataFrame:
    return df.withColumn("power", F.col("voltage") * F.col("current"))


def _windows(w: WindowSpec) -> dict[str, Column]:
    recent = w.rowsBetween(1 - ROLLING_ROWS, 0)

    def change(c):
        return F.col(c) - F.lag(c, 1).over(w)

    return {
        "temp_rolling_mean": F.avg("temperature").over(recent),
        "temp_rolling_std": F.stddev_samp("temperature").over(recent),
        "voltage_rolling_mean": F.avg("voltage").over(recent),
        "current_rolling_mean": F.avg("current").over(recent),
        "temp_change": change("temperature"),
        "voltage_change": change("voltage"),
    }


def derive_features(df: DataFrame, axis: Axis = Axis()) -> DataFrame:
    """Rolling, difference and power columns, all from one shuffle and one sort."""
    return power(over_rows(df, axis, ROLLING_ROWS - 1, _windows))


def engineer_features(df: DataFrame, axis: Axis = Axis()) -> DataFrame:
    """All features, then a backward fill of the whole table, from one shuffle of the rows.

    The fill also replaces missing readings and labels by later ones, so early rows
    may hold values from their future. That is part of the feature definition.
    """
    return over_rows_filled(df, axis, ROLLING_ROWS - 1, _windows, power)
