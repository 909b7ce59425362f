"""Table profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.quantiles import quantile_columns


def ingest_profile(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """One row: rows, columns, first and last timestamp, cells."""
    width = len(df.columns)
    return df.agg(
        F.count("*").alias("rows"),
        F.lit(width).cast("bigint").alias("columns"),
        F.min(ts).alias("first_timestamp"),
        F.max(ts).alias("last_timestamp"),
        (F.count("*") * width).alias("cells"),
    )


def preview(df: DataFrame, order: str = "seq", n: int = 5) -> DataFrame:
    """First n rows in file order."""
    return df.orderBy(order).limit(n)


def describe(
    df: DataFrame,
    columns: Sequence[str],
    approximate: bool = False,
) -> DataFrame:
    """Per column: count, mean, sample std, min, quartiles, max."""
    quartiles = quantile_columns(df, columns, (0.25, 0.5, 0.75), approximate=approximate)
    summaries = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            quartiles[c].alias("quartiles"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    rows = df.agg(F.array(*summaries).alias("rows")).select(F.inline("rows"))
    return rows.select(
        "column",
        "count",
        "mean",
        "std",
        "min",
        F.col("quartiles")[0].alias("p25"),
        F.col("quartiles")[1].alias("p50"),
        F.col("quartiles")[2].alias("p75"),
        "max",
    )


def added_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns a stage added, in table order; metadata only."""
    return [c for c in after.columns if c not in before.columns]


def feature_summary(before: DataFrame, after: DataFrame) -> dict[str, int]:
    return {
        "original": len(before.columns),
        "new": len(added_columns(before, after)),
        "total": len(after.columns),
    }
