"""Synthetic telemetry as Spark table jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.hashing import hash_normal, hash_uniform
from pulsegrid.functions.numbers import count_where, percent
from pulsegrid.operators.sampling import flag_sample

# Mean and standard deviation of the normal readings.
NORMAL_READINGS = {
    "temperature": (20.0, 2.0),
    "voltage": (28.0, 0.5),
    "current": (5.0, 0.3),
    "angular_velocity": (0.1, 0.02),
    "solar_power": (140.0, 10.0),
}
# Kind of fault, the column it overwrites, lowest and highest reading.
FAULTS = (
    ("temp_spike", "temperature", 35.0, 45.0),
    ("voltage_drop", "voltage", 20.0, 24.0),
    ("power_loss", "solar_power", 20.0, 60.0),
    ("spin", "angular_velocity", 0.5, 1.0),
)
START = "2024-01-01 00:00:00"
FAULT_FRACTION = 0.05
SEED = 42


def minute_column(seq, start: str = START):
    """start + seq minutes."""
    whole = F.lit(start).cast("timestamp_ntz")
    return whole + F.make_dt_interval(F.lit(0), F.lit(0), seq.cast("int"), F.lit(0))


def time_spine(
    spark: SparkSession, days: int = 90, samples_per_day: int = 1440, start: str = START
) -> DataFrame:
    """days * samples_per_day rows, always one minute apart."""
    rows = spark.range(days * samples_per_day).withColumnRenamed("id", "seq")
    return rows.withColumn("timestamp", minute_column(F.col("seq"), start))


def gaussian_columns(
    df: DataFrame,
    specs: Mapping[str, tuple[float, float]] = NORMAL_READINGS,
    key: str = "seq",
    seed: object = SEED,
) -> DataFrame:
    """Add independent normal columns with the given mean and standard deviation."""
    return df.withColumns(
        {
            name: F.lit(mean) + F.lit(std) * hash_normal(f"{seed}:{name}", key)
            for name, (mean, std) in specs.items()
        }
    )


def inject_faults(
    df: DataFrame,
    faults: Sequence[tuple[str, str, float, float]] = FAULTS,
    fraction: float = FAULT_FRACTION,
    key: str = "seq",
    seed: object = SEED,
    label: str = "is_anomaly",
) -> DataFrame:
    """Overwrite one reading on exactly floor(n * fraction) rows and label them 1.

    Each chosen row gets one kind of fault, all kinds equally likely, with the
    faulty reading uniform between its limits.
    """
    chosen = flag_sample(df, fraction, key, f"{seed}:rows", "_chosen")
    kind = F.floor(hash_uniform(f"{seed}:kind", key) * len(faults))
    size = hash_uniform(f"{seed}:size", key)
    overwritten = {}
    for index, (_, column, low, high) in enumerate(faults):
        hit = F.col("_chosen") & (kind == index)
        before = overwritten.get(column, F.col(column))
        overwritten[column] = F.when(hit, F.lit(low) + F.lit(high - low) * size).otherwise(before)
    labelled = F.when(F.col("_chosen"), 1).otherwise(0)
    return chosen.withColumns({**overwritten, label: labelled}).drop("_chosen")


def generate_telemetry(
    spark: SparkSession, days: int = 90, samples_per_day: int = 1440, seed: object = SEED
) -> DataFrame:
    """Per-minute readings with labelled faults; ``seq`` is the row's place in the table."""
    readings = gaussian_columns(time_spine(spark, days, samples_per_day), seed=seed)
    return inject_faults(readings, seed=seed)


def label_breakdown(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """One row: normal and anomalous rows and the share of anomalous ones."""
    anomalous = count_where(F.col(label) == 1)
    return df.agg(
        count_where(F.col(label) == 0).alias("normal"),
        anomalous.alias("anomalous"),
        percent(anomalous, F.count("*")).alias("anomalous_pct"),
    )
