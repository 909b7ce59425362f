"""Reading and writing the pipeline tables."""

from __future__ import annotations

import re
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.numbers import nan_to_null

# CSV fields that count as missing.
NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


#: Bits of a row's place within its file, and the files that fit above them.
ROW_BITS = 42
MOST_FILES = 1 << 21


def nan_columns_to_null(df: DataFrame) -> DataFrame:
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[nan_to_null(F.col(c)).alias(c) if c in floating else F.col(c) for c in df.columns]
    )


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    multi_line: bool = False,
    file_order: str | None = None,
) -> DataFrame:
    """Scan a table; missing files raise, missing and NaN fields become NULL.

    CSV needs a header. With a schema, columns are found by name and a field that
    does not fit its type raises; without one, types are inferred, which costs an
    extra pass over the files. ``multi_line`` allows line breaks inside quoted
    fields, but then a file cannot be split between tasks: keep such files small
    or many, or use parquet.

    ``file_order`` names an extra integer column that sorts rows as the files hold them. For
    CSV it costs a pass that finds where each block of a file begins.
    """
    if fmt == "parquet":
        reader = spark.read.schema(schema) if schema else spark.read
        df = reader.parquet(path)
    elif fmt == "csv":
        reader = spark.read.option("header", True).option("escape", '"')
        reader = reader.option("multiLine", multi_line)
        if schema is None:
            df = reader.option("inferSchema", True).csv(path)
        else:
            # Without a schema to impose, columns are strings named by the header.
            df = reader.csv(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")

    if file_order:
        df = _with_file_order(df, file_order, fmt)
    if fmt == "csv" and schema is not None:
        extra = [F.col(file_order)] if file_order else []
        df = df.select(*[_parse(f) for f in schema if f.name in df.columns], *extra)
    return nan_columns_to_null(df)


def _with_file_order(df: DataFrame, name: str, fmt: str) -> DataFrame:
    """Number of the file, then the place within it, as one integer.

    Files go by the number in a part file's name, as its digits are not padded beyond five,
    then by path. The list of files is what the driver planned the scan with. A parquet row has
    its number. A CSV row has that of its block's first byte plus its number in the block,
    which is below the next block's, as no row is shorter than a byte.
    """
    spark = df.sparkSession

    def place(path: str) -> tuple[int, str]:
        part = re.search(r"/part-(\d+)[^/]*$", path)
        return (int(part[1]) if part else -1, path)

    files = sorted((re.sub("^file:/+", "file:/", path) for path in df.inputFiles()), key=place)
    if len(files) >= MOST_FILES:
        raise ValueError(f"more than {MOST_FILES} files have no order in one integer")
    listed = spark.createDataFrame(list(enumerate(files)), "_file int, _path string")
    path = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")
    if fmt == "parquet":
        rows = df.select("*", path.alias("_path"), F.col("_metadata.row_index").alias("_row"))
    else:
        block = F.col("_metadata.file_block_start").alias("_block")
        task_row = F.monotonically_increasing_id().alias("_at")
        # Both scans deal the same blocks to the same tasks.
        firsts = df.select(path.alias("_path"), block, task_row).groupBy("_path", "_block")
        firsts = firsts.agg(F.min("_at").alias("_first"))
        rows = df.select("*", path.alias("_path"), block, task_row).join(firsts, ["_path", "_block"])
        rows = rows.withColumn("_row", F.col("_block") + F.col("_at") - F.col("_first"))
    known = rows.join(listed, "_path", "left")
    number = F.coalesce("_file", F.raise_error(F.lit("a file is not on the list of the scan")).cast("int"))
    order = F.shiftleft(number.cast("bigint"), ROW_BITS) + F.col("_row")
    return known.select(*df.columns, order.alias(name))


def _parse(field: T.StructField) -> Column:
    raw = F.col(field.name)
    present = F.when(~raw.isin(*NA_VALUES), raw)
    return present.cast(field.dataType).alias(field.name)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write part files in parallel, replacing the table; returns the path."""
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        # The default format would cut timestamps to milliseconds.
        writer = writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return path


def write_report(report: DataFrame, folder: str, prefix: str = "health_report") -> str:
    """Write a one-row report as text lines into a folder of its own, named by the time."""
    path = f"{folder.rstrip('/')}/{prefix}_{datetime.now():%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
    report.select(report_text(report).alias("value")).coalesce(1).write.text(path)
    return path


def report_text(report: DataFrame) -> Column:
    """``name: value`` lines; counts get separators, rates two decimals, others four."""
    lines = []
    for field in report.schema:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.LongType, T.IntegerType)):
            value = F.format_number(value, 0)
        elif isinstance(field.dataType, T.DoubleType):
            value = F.format_number(value, 2 if field.name.endswith("pct") else 4)
        shown = F.coalesce(value.cast("string"), F.lit("n/a"))
        lines.append(F.concat(F.lit(field.name.replace("_", " ") + ": "), shown))
    return F.concat_ws("\n", *lines)
