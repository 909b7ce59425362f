"""Sentiment classifier: TF-IDF and L2 logistic regression as one MLlib pipeline."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from pulsegrid.operators.textfeatures import MAX_FEATURES, fit_tfidf, map_label, terms

# Label codes and solver limit.
LABELS = {"positive": 1, "negative": 0}
MAX_ITER = 1000
TOLERANCE = 1e-6


def binary_labels(df: DataFrame, column: str = "sentiment", out: str = "label") -> DataFrame:
    return map_label(df, column, LABELS, out)


def fit_sentiment(
    df: DataFrame,
    text: str = "cleaned_review",
    label: str = "label",
    max_features: int = MAX_FEATURES,
    inverse_strength: float = 1.0,
) -> PipelineModel:
    """Fit on cleaned texts with 0/1 labels.

    The penalty is ``1 / (C * n)`` because MLlib averages the loss over rows where
    the usual C formulation sums it; the intercept is not penalised and features
    are not rescaled.
    """
    examples = df.select(F.col(text).alias("text"), F.col(label).cast("double").alias("label"))
    n, labelled = examples.select(F.count("*"), F.count("label")).first()
    if labelled < n:
        raise ValueError(f"{n - labelled} rows without a label: drop them or map their values")
    model = fit_tfidf(examples, "text", max_features=max_features, n_documents=n)
    vectors = examples.select("label", terms("text").alias("terms"))
    for stage in model.stages:
        vectors = stage.transform(vectors)
    vectors = vectors.select("label", "features")
    # Solver passes read this again and again; lost blocks are recomputed.
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        classifier = LogisticRegression(
            maxIter=MAX_ITER,
            regParam=1.0 / (inverse_strength * n),
            elasticNetParam=0.0,
            standardization=False,
            tol=TOLERANCE,
        ).fit(vectors)
    finally:
        vectors.unpersist()
    return PipelineModel([*model.stages, classifier])


def predict(df: DataFrame, model: PipelineModel, cleaned: str | Column) -> DataFrame:
    """Add ``prediction`` (0/1) and ``probability`` (array) to the table."""
    prepared = df.withColumn("terms", terms(cleaned))
    result = model.transform(prepared)
    return result.select(
        *df.columns,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability").alias("probability"),
    )


def sentiment_columns(
    df: DataFrame, prediction: str = "prediction", probability: str = "probability"
) -> DataFrame:
    """Turn class and probabilities into ``sentiment`` and ``confidence``.

    Confidence is the probability of the predicted class.
    """
    chosen = F.col(prediction)
    return df.withColumns(
        {
            "sentiment": F.when(chosen == 1, "positive").otherwise("negative"),
            "confidence": F.element_at(probability, chosen + 1),
        }
    ).drop(prediction, probability)
