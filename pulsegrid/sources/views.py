"""Telemetry and review tables derived from a general events/documents schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.sources.tables import nan_columns_to_null


def telemetry_view(spark: SparkSession, folder: str) -> DataFrame:
    """One reading per event; ``seq`` is the file order, ``user_id`` the entity."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    derived = events.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))
    return nan_columns_to_null(
        derived.select(
            F.col("event_id").alias("seq"),
            "user_id",
            F.col("ts").alias("timestamp"),
            F.col("value").alias("temperature"),
            F.nullif(F.col("k"), F.lit(0)).cast("double").alias("voltage"),
            (F.col("value") / (F.col("k") + 1)).alias("current"),
            ((F.col("event_id") % 100) / F.lit(100.0)).alias("angular_velocity"),
            (F.col("value") * 2 + F.col("k")).alias("solar_power"),
            F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_anomaly"),
        )
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return texts.withColumnRenamed("text", "review")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html")


def reviews_view(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents as reviews. Left to the optimizer: AQE picks the join."""
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    sentiment = F.when(F.col("quality") == 1, "positive").otherwise("negative")
    return (
        documents(spark, folder)
        .join(labels, "doc_id")
        .select("doc_id", "review", sentiment.alias("sentiment"))
    )
