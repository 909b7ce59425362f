"""Column contracts of the tables the pipelines exchange."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and their order in the telemetry tables.
TIMESTAMP = "timestamp"
LABEL = "is_anomaly"
METRICS = ("temperature", "voltage", "current", "angular_velocity", "solar_power")
REQUIRED_COLUMNS = (TIMESTAMP, *METRICS)
FEATURE_COLS = (
    "temperature",
    "voltage",
    "current",
    "angular_velocity",
    "solar_power",
    "temp_rolling_mean",
    "voltage_rolling_mean",
    "current_rolling_mean",
    "power",
)

TELEMETRY = T.StructType(
    [T.StructField(TIMESTAMP, T.TimestampNTZType())]
    + [T.StructField(c, T.DoubleType()) for c in METRICS]
    + [T.StructField(LABEL, T.IntegerType())]
)

REVIEWS = T.StructType(
    [T.StructField("review", T.StringType()), T.StructField("sentiment", T.StringType())]
)
HOLDOUT = T.StructType(
    [T.StructField("review", T.StringType()), T.StructField("sentiment", T.IntegerType())]
)
