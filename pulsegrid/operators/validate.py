"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.numbers import count_where
from pulsegrid.operators.series import FAN, segment_groups
from pulsegrid.schemas import REQUIRED_COLUMNS

# Inclusive limits of plausible readings.
PLAUSIBLE = {"temperature": (-50.0, 100.0), "voltage": (20.0, 35.0)}
TOTAL = "(total)"


def require_columns(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Pass the table on, or raise naming the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"the table has no column named {', '.join(missing)}")
    return df


def _is_missing(df: DataFrame, column: str) -> Column:
    missing = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(column)
    return missing


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing cells per column and in total, from one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(*[count_where(_is_missing(df, c)).alias(c) for c in columns])
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    rows = [(F.lit(c), F.col(c)) for c in columns] + [(F.lit(TOTAL), total)]
    structs = [F.struct(name.alias("column"), n.alias("n_missing")) for name, n in rows]
    return counted.select(F.inline(F.array(*structs)))


def range_check(
    df: DataFrame, limits: Mapping[str, tuple[float, float]] = PLAUSIBLE
) -> DataFrame:
    """Per column: limits, extremes, whether both lie within, rows outside."""
    structs = []
    for column, (low, high) in limits.items():
        value = F.col(column)
        structs.append(
            F.struct(
                F.lit(column).alias("column"),
                F.lit(float(low)).alias("lo"),
                F.lit(float(high)).alias("hi"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
                # A column without values has nothing out of range.
                F.coalesce((F.min(value) >= low) & (F.max(value) <= high), F.lit(True)).alias("ok"),
                count_where((value < low) | (value > high)).alias("n_outside"),
            )
        )
    return df.agg(F.array(*structs).alias("rows")).select(F.inline("rows"))


def is_sorted(
    df: DataFrame,
    ts: str = "timestamp",
    seq: str = "seq",
    keys: Sequence[str] = (),
    rows_per_bucket: int = 1_000_000,
    fan: int = FAN,
) -> DataFrame:
    """One row: whether timestamps never fall in file order (ties allowed).

    A missing timestamp makes the answer false. Neighbours are compared within
    buckets of file order, then the ends of neighbouring buckets in groups of ``fan``, then
    the ends of the groups, so no task sees all rows or all buckets. ``seq`` is an integer
    such as ``read_table(file_order=...)`` makes.
    """
    bucket = F.floor(F.col(seq) / rows_per_bucket)
    rows = df.select(*keys, bucket.alias("_bucket"), F.col(seq).alias("_seq"), F.col(ts).alias("_ts"))
    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy("_seq")
    ends = (
        rows.withColumn("_before", F.lag("_ts").over(in_bucket))
        .groupBy(*keys, "_bucket")
        .agg(
            count_where(F.col("_ts").isNull() | (F.col("_ts") < F.col("_before"))).alias("_bad"),
            F.min_by("_ts", "_seq").alias("_first"),
            F.max_by("_ts", "_seq").alias("_last"),
        )
    )
    # The ends of neighbouring buckets, group by group of buckets, then the ends of groups.
    ends = segment_groups(ends, keys, "_bucket", fan)
    before = F.lag("_last").over(Window.partitionBy(*keys, "_group").orderBy("_bucket"))
    steps = ends.withColumn("_before", before).groupBy(*keys, "_group").agg(
        F.sum("_bad").alias("_bad"),
        count_where(F.col("_first") < F.col("_before")).alias("_falls"),
        F.min_by("_first", "_bucket").alias("_first"),
        F.max_by("_last", "_bucket").alias("_last"),
    )
    between = Window.partitionBy(*keys).orderBy("_group")
    steps = steps.withColumn("_before", F.lag("_last").over(between))
    bad = F.coalesce(F.sum(F.col("_bad") + F.col("_falls")), F.lit(0))
    return steps.agg((bad + count_where(F.col("_first") < F.col("_before")) == 0).alias("is_sorted"))


def validate(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    limits: Mapping[str, tuple[float, float]] = PLAUSIBLE,
    ts: str = "timestamp",
    seq: str = "seq",
    keys: Sequence[str] = (),
) -> DataFrame:
    """All checks as one table; a missing column raises before any job runs."""
    require_columns(df, required)
    none = F.lit(None).cast("double")
    nulls = null_counts(df).select(
        F.lit("missing_values").alias("check"),
        "column",
        (F.col("n_missing") == 0).alias("ok"),
        F.col("n_missing").alias("n"),
        none.alias("min"),
        none.alias("max"),
    )
    ranges = range_check(df, limits).select(
        F.lit("range").alias("check"),
        "column",
        "ok",
        F.col("n_outside").alias("n"),
        F.col("min").cast("double").alias("min"),
        F.col("max").cast("double").alias("max"),
    )
    order = is_sorted(df, ts, seq, keys).select(
        F.lit("sorted").alias("check"),
        F.lit(ts).alias("column"),
        F.col("is_sorted").alias("ok"),
        F.lit(None).cast("bigint").alias("n"),
        none.alias("min"),
        none.alias("max"),
    )
    return nulls.unionByName(ranges).unionByName(order)
