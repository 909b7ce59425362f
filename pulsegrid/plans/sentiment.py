"""Review sentiment from training to prediction."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.text import clean_text
from pulsegrid.operators.evaluate import binary_metrics, classification_report, confusion_matrix
from pulsegrid.operators.sampling import exact_split
from pulsegrid.operators.sentiment import binary_labels, fit_sentiment, predict, sentiment_columns
from pulsegrid.operators.termmodel import fit_term_model, predict_by_terms
from pulsegrid.operators.textfeatures import clean_reviews
from pulsegrid.sources.tables import read_table, write_table

TEST_FRACTION = 0.2
SEED = 42


def prepare_reviews(reviews: DataFrame) -> DataFrame:
    """Cleaned text and 0/1 label next to the original columns."""
    return binary_labels(clean_reviews(reviews))


def train_sentiment(
    reviews: DataFrame, key: str, out: str | None = None, seed: object = SEED
) -> tuple[PipelineModel, DataFrame]:
    """Fit on 80 % of the reviews; returns the model and the held-out rest.

    With ``out``, the model goes to ``<out>/model`` and the hold-out, as cleaned
    review and 0/1 sentiment, to ``<out>/holdout``.
    """
    train, test = exact_split(prepare_reviews(reviews), TEST_FRACTION, key, seed)
    model = fit_sentiment(train)
    holdout = test.select(F.col("cleaned_review").alias("review"), F.col("label").alias("sentiment"))
    if out:
        model.write().overwrite().save(f"{out}/model")
        write_table(holdout, f"{out}/holdout")
        holdout = read_table(reviews.sparkSession, f"{out}/holdout")
    return model, holdout


def predict_reviews(reviews: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``sentiment`` and ``confidence`` to a batch or streaming table of reviews."""
    return sentiment_columns(predict(reviews, model, clean_text(F.col("review"))))


def train_term_model(
    reviews: DataFrame, key: str, out: str, rounds: int, seed: object = SEED
) -> tuple[DataFrame, DataFrame]:
    """As ``train_sentiment``, with a model that is a table, written to ``<out>/terms``.

    The hold-out keeps its key.
    """
    spark = reviews.sparkSession
    train, test = exact_split(prepare_reviews(reviews), TEST_FRACTION, key, seed)
    train = read_table(spark, write_table(train.select(key, "cleaned_review", "label"), f"{out}/train"))
    write_table(fit_term_model(train, "cleaned_review", key, "label", rounds), f"{out}/terms")
    holdout = test.select(key, F.col("cleaned_review").alias("review"), F.col("label").alias("sentiment"))
    write_table(holdout, f"{out}/holdout")
    return read_table(spark, f"{out}/terms"), read_table(spark, f"{out}/holdout")


def predict_by_table(reviews: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """Add ``sentiment`` and ``confidence`` by a join with a table of terms."""
    return sentiment_columns(predict_by_terms(reviews, terms, clean_text(F.col("review")), key))


def evaluations(scored: DataFrame) -> dict[str, DataFrame]:
    return {
        "metrics": binary_metrics(scored, "sentiment", "prediction"),
        "confusion": confusion_matrix(scored, "sentiment", "prediction"),
        "report": classification_report(scored, "sentiment", "prediction"),
    }


def evaluate_model(
    spark: SparkSession, model_path: str, holdout_path: str
) -> dict[str, DataFrame]:
    """Quality of a saved model on a saved hold-out table."""
    model = PipelineModel.load(model_path)
    scored = predict(read_table(spark, holdout_path), model, "review")
    scored = scored.select("sentiment", "prediction")
    return evaluations(scored)


def run_sentiment(
    reviews: DataFrame, key: str, out: str, seed: object = SEED
) -> dict[str, DataFrame]:
    """Train, evaluate on the hold-out, predict all reviews."""
    spark = reviews.sparkSession
    model, _ = train_sentiment(reviews, key, out, seed)
    results = evaluate_model(spark, f"{out}/model", f"{out}/holdout")
    return results | {"predictions": predict_reviews(reviews.select(key, "review"), model)}
