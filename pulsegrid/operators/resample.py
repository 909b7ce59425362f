"""Cleaning and resampling of time series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.numbers import percent

HOUR = 3600
BINS_PER_BLOCK = 65_536


def parse_ts(df: DataFrame, column: str = "timestamp", strict: bool = True) -> DataFrame:
    """Text to timestamp; an unreadable one raises, or becomes NULL if not strict."""
    text = F.col(column)
    parsed = text.cast("timestamp_ntz") if strict else text.try_cast("timestamp_ntz")
    return df.withColumn(column, parsed)


def dedupe_first(df: DataFrame, by: Sequence[str], seq: str = "seq") -> DataFrame:
    """Keep the row that comes first in file order of each group of equal ``by``.

    One ``min_by`` per column: with fixed-width columns this is a hash aggregate
    that already drops copies before the shuffle, so a group holding a large share
    of the table costs no more than any other.
    """
    rest = [c for c in df.columns if c not in by and c != seq]
    kept = df.groupBy(*by).agg(
        F.min(seq).alias(seq), *[F.min_by(c, seq).alias(c) for c in rest]
    )
    return kept.select(*df.columns)


def bin_start(ts: str | Column, step: int = HOUR) -> Column:
    """Start of the left-closed bin of ``step`` seconds that holds the timestamp."""
    return F.window(ts, f"{step} seconds")["start"]


def _seconds(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n))


def bin_spine(
    df: DataFrame,
    ts: str = "timestamp",
    step: int = HOUR,
    keys: Sequence[str] = (),
    max_bins: int | None = None,
) -> DataFrame:
    """Every bin from the first to the last of each series.

    Bins are generated in blocks spread over the cluster, so a long series is not
    unrolled by one task. ``max_bins`` guards against a stray far-off timestamp: a
    longer series raises.
    """
    spark = df.sparkSession
    span = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    span = span.select(*keys, bin_start("_lo", step).alias("_lo"), "_hi")
    if max_bins is not None:
        limit = F.col("_lo") + _seconds(step * (max_bins - 1)) + _seconds(step)
        message = F.lit(f"series longer than {max_bins} bins of {step} seconds")
        span = span.withColumn(
            "_hi", F.when(F.col("_hi") < limit, F.col("_hi")).otherwise(F.raise_error(message))
        )
    block = step * BINS_PER_BLOCK
    blocks = span.select(
        *keys, "_hi", F.explode(F.sequence("_lo", "_hi", _seconds(block))).alias("_from")
    )
    # A fixed number of partitions: these few bytes would otherwise be merged into one task.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    last = F.least(F.col("_hi"), F.col("_from") + _seconds(block - step))
    return blocks.repartition(tasks, *keys, "_from").select(
        *keys, F.explode(F.sequence(F.col("_from"), last, _seconds(step))).alias(ts)
    )


def resample_mean(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    ts: str = "timestamp",
    step: int = HOUR,
    keys: Sequence[str] = (),
    label: str | None = None,
    seq: str | None = "seq",
    span: DataFrame | None = None,
    max_bins: int | None = None,
) -> DataFrame:
    """Mean of each column per bin, missing values skipped, empty bins kept as NULL.

    ``label`` is set to 1 where its mean is above 0, else (also in an empty bin) 0.
    Rows without a timestamp are left out. The empty bins come from rows without
    readings that are added before the one aggregation, so no join is needed.

    ``span`` is a table with the same first and last timestamps that is cheaper to
    scan than ``df``, such as the raw rows before duplicates were dropped.
    """
    if columns is None:
        skip = {ts, seq, label, *keys}
        columns = [
            f.name
            for f in df.schema
            if isinstance(f.dataType, T.NumericType) and f.name not in skip
        ]
    measured = [*columns, label] if label else list(columns)
    readings = df.select(
        *keys, bin_start(ts, step).alias(ts), *[F.col(c).cast("double").alias(c) for c in measured]
    )
    spine = bin_spine(span if span is not None else df, ts, step, keys, max_bins)
    empty = spine.select("*", *[F.lit(None).cast("double").alias(c) for c in measured])
    means = readings.unionByName(empty).groupBy(*keys, ts).agg(*[F.avg(c).alias(c) for c in measured])
    if label:
        means = means.withColumn(label, F.when(F.col(label) > 0, 1).otherwise(0))
    return means


def resample_summary(
    raw: DataFrame, deduped: DataFrame, resampled: DataFrame, ts: str = "timestamp"
) -> DataFrame:
    """One row: rows before and after each step, reduction in percent, time range."""
    n_raw = raw.agg(F.count("*")).scalar()
    n_kept = deduped.agg(F.count("*")).scalar()
    counted = resampled.agg(
        F.count("*").alias("rows_out"),
        F.min(ts).alias("first_timestamp"),
        F.max(ts).alias("last_timestamp"),
    ).select(n_raw.alias("rows_in"), n_kept.alias("rows_kept"), "*")
    return counted.select(
        "rows_in",
        (F.col("rows_in") - F.col("rows_kept")).alias("duplicates_removed"),
        "rows_out",
        percent(F.col("rows_kept") - F.col("rows_out"), F.col("rows_kept")).alias("reduction_pct"),
        "first_timestamp",
        "last_timestamp",
    )
