"""Helpers that the operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import scratch_dir

BUCKETS = 1 << 30
#: Whether Spark removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def named(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a stage's rows to the shared scratch folder and read them back.

    This cuts the lineage: an executor lost later costs no earlier stage. The files of the
    shuffles go when the rows are written, not when the driver next collects its garbage.
    """
    spark = df.sparkSession
    path, before = scratch_dir(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def in_file_order(df: DataFrame) -> DataFrame:
    """Partitions and rows in the order in which a table's part files were written.

    A scan deals out file splits by size. Part files go by the number in their name, as its
    digits are not padded beyond five. Rows that come from no file stay as they are.
    """
    try:
        meta = df.metadataColumn("_metadata")
        path, row = meta["file_path"], meta["row_index"]
        part = F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1)
        part = F.coalesce(F.nullif(part, F.lit("")).cast("long"), F.lit(-1))
        numbered = df.withColumn("_file_order", F.struct(part.alias("part"), path.alias("path"), row.alias("row")))
    except AnalysisException:
        return df
    return numbered.repartitionByRange("_file_order").sortWithinPartitions("_file_order").drop("_file_order")


def hash_share(df: DataFrame, key: Column, rows: int, total: int | None = None) -> DataFrame:
    """About ``rows`` rows, picked by a hash of the key; all rows if there are fewer."""
    n = df.count() if total is None else total
    if n <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(key, F.lit("share")), F.lit(BUCKETS)) < int(BUCKETS * rows / n))


def per_process(name: str, make: Callable):
    """One object per Python worker process; Spark reuses workers from task to task."""
    holder = sys.modules.setdefault("_pulsegrid_process", types.ModuleType("_pulsegrid_process"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def shared_file(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system that all executors share, and the path on it."""
    return pafs.FileSystem.from_uri(path)


def slices(batch: pa.RecordBatch, column: str, bound: int):
    """Cut a batch into runs of rows with about ``bound`` bytes of text, one row at least."""
    start, size = 0, 0
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    for i, n in enumerate(lengths):
        if size and size + n > bound:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
