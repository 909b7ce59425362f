"""Health statistics: averages, 3-sigma outliers, anomaly rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.numbers import count_where, percent, status
from pulsegrid.schemas import METRICS

SIGMA_COLUMNS = ("temperature", "voltage")
SIGMAS = 3.0


def averages(columns: Sequence[str] = METRICS) -> list[Column]:
    return [F.avg(c).alias(f"avg_{c}") for c in columns]


def system_averages(df: DataFrame, columns: Sequence[str] = METRICS) -> DataFrame:
    """One row: number of samples and the mean of each metric."""
    return df.agg(F.count("*").alias("total_samples"), *averages(columns))


def _spread(df: DataFrame, columns: Sequence[str]) -> Column:
    """Mean and sample std per column as one scalar: a single row, computed once."""
    moments = [F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")) for c in columns]
    return df.agg(F.struct(*[m.alias(c) for m, c in zip(moments, columns)]).alias("m")).scalar()


def _is_outlier(spread: Column, column: str, k: float) -> Column:
    moments = spread.getField(column)
    distance = F.abs(F.col(column) - moments.getField("mean"))
    return distance > F.lit(k) * moments.getField("std")


def sigma_filter(df: DataFrame, column: str, k: float = SIGMAS) -> DataFrame:
    """Rows further than k sample standard deviations from the mean; never missing ones."""
    return df.filter(_is_outlier(_spread(df, [column]), column, k))


def flag_outliers(
    df: DataFrame, columns: Sequence[str] = SIGMA_COLUMNS, k: float = SIGMAS
) -> DataFrame:
    """Add ``<column>_outlier`` (boolean) per column."""
    spread = _spread(df, columns)
    return df.withColumns(
        {
            f"{c}_outlier": F.coalesce(_is_outlier(spread, c, k), F.lit(False))
            for c in columns
        }
    )


def sigma_outliers(
    df: DataFrame, columns: Sequence[str] = SIGMA_COLUMNS, k: float = SIGMAS
) -> DataFrame:
    """Per metric: mean, sample std, outliers, outliers in percent of all rows."""
    flagged = flag_outliers(df, columns, k)
    rows = []
    for c in columns:
        n_outliers = count_where(F.col(f"{c}_outlier"))
        rows.append(
            F.struct(
                F.lit(c).alias("metric"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                n_outliers.alias("n_outliers"),
                percent(n_outliers, F.count("*")).alias("outlier_pct"),
            )
        )
    return flagged.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def simple_report(df: DataFrame, k: float = SIGMAS) -> DataFrame:
    """3-sigma health report, one row.

    The overall rate adds the outliers of both metrics, so a row outlying on both
    counts twice.
    """
    counted = flag_outliers(df, SIGMA_COLUMNS, k).agg(
        F.count("*").alias("total_samples"),
        *averages(),
        count_where(F.col("temperature_outlier")).alias("temp_anomalies"),
        count_where(F.col("voltage_outlier")).alias("voltage_anomalies"),
    )
    total = F.col("total_samples")
    both = F.col("temp_anomalies") + F.col("voltage_anomalies")
    return counted.select(
        "*",
        percent(F.col("temp_anomalies"), total).alias("temp_anomaly_pct"),
        percent(F.col("voltage_anomalies"), total).alias("voltage_anomaly_pct"),
        percent(both, total).alias("anomaly_rate_pct"),
    ).withColumn("status", status(F.col("anomaly_rate_pct")))


def overall_rate(df: DataFrame, k: float = SIGMAS) -> DataFrame:
    return simple_report(df, k).select("anomaly_rate_pct", "status")


def prediction_counts(df: DataFrame, flag: str = "is_predicted_anomaly") -> DataFrame:
    """One row: predicted anomalies and normal rows with their percentages."""
    n_flagged = count_where(F.col(flag) == 1)
    n_normal = count_where(F.col(flag) == 0)
    return df.agg(
        F.count("*").alias("total_samples"),
        n_flagged.alias("predicted_anomalies"),
        n_normal.alias("predicted_normal"),
        percent(n_flagged, F.count("*")).alias("anomaly_pct"),
        percent(n_normal, F.count("*")).alias("normal_pct"),
    )
