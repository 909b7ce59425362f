"""Sentiment prediction on a stream of review files."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.plans.sentiment import predict_reviews


def read_review_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet"
) -> DataFrame:
    """New parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", 1000)
        .parquet(folder)
    )


def read_table_stream(
    spark: SparkSession, folder: str, name: str, schema: T.StructType
) -> DataFrame:
    """All files of a table as a stream, be the table one file or a folder of files.

    A source cannot be a file by its own path, so that one is picked from its folder by name.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    found = path.getFileSystem(conf).globStatus(path) or []
    if any(status.isDirectory() for status in found):
        return read_review_stream(spark, f"{folder}/{name}", schema, "*")
    return read_review_stream(spark, folder, schema, name)


def start_predictions(
    reviews: DataFrame, model: PipelineModel, out: str, checkpoint: str
) -> StreamingQuery:
    """Score all files present and stop. Prediction is stateless, so the same
    transformation as for tables applies; a restart goes on from the checkpoint."""
    return (
        predict_reviews(reviews, model)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
