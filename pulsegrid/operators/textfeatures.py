"""Vocabulary and TF-IDF over n-grams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.text import clean_text, let, ngrams, tokens

# Fixed value: terms kept.
MAX_FEATURES = 5000


def clean_reviews(df: DataFrame, column: str = "review", out: str = "cleaned_review") -> DataFrame:
    return df.withColumn(out, clean_text(F.col(column)))


def map_label(df: DataFrame, column: str, mapping: dict[str, int], out: str) -> DataFrame:
    """Replace values by the mapping; anything else becomes missing."""
    cases = [F.when(F.col(column) == value, number) for value, number in mapping.items()]
    return df.withColumn(out, F.coalesce(*cases))


def terms(text: str | Column) -> Column:
    """Uni- and bigrams of a text."""
    return ngrams(tokens(F.col(text) if isinstance(text, str) else text), (1, 2))


def vocabulary(df: DataFrame, text: str, max_features: int = MAX_FEATURES) -> DataFrame:
    """Terms with the highest total count, ties by term: term, tf, df.

    One pass and one shuffle: each document yields its distinct terms, then all its
    terms, and both are counted per term before the shuffle, so a term found in
    every document is no hot key.
    """

    def twice(all_terms: Column) -> Column:
        distinct = F.array_distinct(all_terms)
        return F.struct(
            F.size(distinct).alias("n_distinct"), F.concat(distinct, all_terms).alias("both")
        )

    documents = df.select(let(terms(text), twice).alias("d"))
    uses = documents.select("d.n_distinct", F.posexplode("d.both").alias("place", "term"))
    return (
        uses.groupBy("term")
        .agg(
            F.count_if(F.col("place") >= F.col("n_distinct")).alias("tf"),
            F.count_if(F.col("place") < F.col("n_distinct")).alias("df"),
        )
        .orderBy(F.desc("tf"), "term")
        .limit(max_features)
    )


@dataclass
class TfidfStages:
    """MLlib stages from a term array to a unit-length TF-IDF vector.

    Each works row by row, so applying them to a table needs no shuffle.
    """

    counts: CountVectorizerModel
    weights: ElementwiseProduct
    norm: Normalizer

    @property
    def stages(self) -> list:
        return [self.counts, self.weights, self.norm]

    @property
    def terms(self) -> list[str]:
        return self.counts.vocabulary


def fit_tfidf(
    df: DataFrame,
    text: str,
    terms_column: str = "terms",
    max_features: int = MAX_FEATURES,
    n_documents: int | None = None,
) -> TfidfStages:
    """Learn vocabulary and weights ln((1 + n) / (1 + df)) + 1.

    The vocabulary, at most ``max_features`` rows, is part of the model and comes
    to the driver. MLlib's IDF stage lacks the + 1, hence the product stage.
    """
    n = F.lit(df.count() if n_documents is None else n_documents)
    weight = F.log((1 + n) / (1 + F.col("df"))) + 1
    learned = vocabulary(df, text, max_features).select("term", weight.alias("weight")).collect()
    if not learned:
        raise ValueError("empty vocabulary: no term in any text")
    counts = CountVectorizerModel.from_vocabulary(
        [r.term for r in learned], inputCol=terms_column, outputCol="tf"
    )
    weights = ElementwiseProduct(
        scalingVec=Vectors.dense([r.weight for r in learned]), inputCol="tf", outputCol="tfidf"
    )
    return TfidfStages(counts, weights, Normalizer(p=2.0, inputCol="tfidf", outputCol="features"))


def tfidf(
    df: DataFrame, text: str, key: str, max_features: int = MAX_FEATURES
) -> DataFrame:
    """Long form of the TF-IDF matrix: key, term, tf, weight (unit length per key)."""
    model = fit_tfidf(df, text, max_features=max_features)
    matrix = df.select(key, terms(text).alias("terms"))
    for stage in model.stages:
        matrix = stage.transform(matrix)
    # Vectors are stored as (type, size, indices, values).
    tf, weight = F.unwrap_udt("tf"), F.unwrap_udt("features")
    cells = F.arrays_zip(
        tf.getField("indices").alias("i"),
        tf.getField("values").alias("tf"),
        weight.getField("values").alias("weight"),
    )
    # At most ``max_features`` rows, so sending them everywhere is safe.
    names = df.sparkSession.createDataFrame(list(enumerate(model.terms)), "i int, term string")
    cells = matrix.select(key, F.explode(cells).alias("cell")).select(key, "cell.*")
    return cells.join(F.broadcast(names), "i").select(
        key, "term", F.col("tf").cast("bigint").alias("tf"), "weight"
    )
