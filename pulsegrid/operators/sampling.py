"""Exact-size random samples and splits without a global sort.

A row belongs to the sample when its key's hash is among the k smallest. The k-th
hash is found by a 65,536-bucket histogram of hash prefixes followed by a sort of
the one bucket the k-th hash falls in (about n / 65,536 rows), so no task ever
holds the table and the rows themselves are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.hashing import hash_hex

PREFIX_DIGITS = 4


def _floor(n: Column, fraction: float) -> Column:
    return F.floor(n * F.lit(fraction))


def _ceil(n: Column, fraction: float) -> Column:
    return F.ceil(n * F.lit(fraction))


def _cutoff(hashed: DataFrame, size: Callable[[Column], Column]) -> str | None:
    """The largest hash still in the sample, or None for an empty sample.

    Computed once and then used as a constant, so neither the two parts of a split
    nor repeated actions on them search for it again.
    """
    hashed = hashed.withColumn("_prefix", F.substring("_hash", 1, PREFIX_DIGITS))
    # At most 16**PREFIX_DIGITS rows, so one task for the running sum is enough.
    upto = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    overall = Window.orderBy("_prefix").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    histogram = (
        hashed.groupBy("_prefix")
        .agg(F.count("*").alias("_n"))
        .select(
            "_prefix",
            "_n",
            F.sum("_n").over(upto).alias("_upto"),
            size(F.sum("_n").over(overall)).alias("_k"),
        )
    )
    edge = histogram.filter("_upto - _n < _k and _k <= _upto").first()
    if edge is None:
        return None
    rank = edge._k - edge._upto + edge._n
    place = F.row_number().over(Window.partitionBy("_prefix").orderBy("_hash"))
    bucket = hashed.filter(F.col("_prefix") == edge._prefix).withColumn("_place", place)
    edges = bucket.filter(F.col("_place").between(rank, rank + 1)).orderBy("_place").collect()
    if len(edges) == 2 and edges[0]._hash == edges[1]._hash:
        raise ValueError("keys do not identify rows: equal keys lie on the edge of the sample")
    return edges[0]._hash


def flag_sample(
    df: DataFrame,
    fraction: float,
    key: str | Sequence[str],
    seed: object = 42,
    flag: str = "chosen",
    round_up: bool = False,
) -> DataFrame:
    """Add a boolean that is true on exactly floor (or ceil) of n * fraction rows.

    ``key`` must identify a row; the choice depends on it and the seed only. Repeated keys
    on the edge of the sample raise, since no exact size could be kept.
    """
    key = [key] if isinstance(key, str) else list(key)
    own = hash_hex(seed, *key)
    size = _ceil if round_up else _floor
    cutoff = _cutoff(df.select(own.alias("_hash")), lambda n: size(n, fraction))
    return df.withColumn(flag, F.lit(False) if cutoff is None else own <= F.lit(cutoff))


def exact_sample(
    df: DataFrame, fraction: float, key: str | Sequence[str], seed: object = 42
) -> DataFrame:
    """floor(n * fraction) rows without replacement."""
    return flag_sample(df, fraction, key, seed, "_chosen").filter("_chosen").drop("_chosen")


def exact_split(
    df: DataFrame, test_fraction: float, key: str | Sequence[str], seed: object = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ceil(n * test_fraction) test rows."""
    flagged = flag_sample(df, test_fraction, key, seed, "_test", round_up=True)
    return flagged.filter("not _test").drop("_test"), flagged.filter("_test").drop("_test")
