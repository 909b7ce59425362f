"""The review classifier as tables: terms with weights and coefficients, fitted and applied by Spark.

A model is a table of ``term, idf, coefficient``; the row of the empty term holds the
intercept, which no text's term can be. Documents are kept as sparse rows, so a round of the
fit reads them once without moving them, and only one partial sum per term and task is
shuffled. Scoring joins terms with the table and adds up per document.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators.textfeatures import MAX_FEATURES, terms, vocabulary
from pulsegrid.session import scratch_dir
from pulsegrid.sources.tables import read_table, write_table

INTERCEPT = ""
#: The term table is broadcast and its coefficients go to every task as one array.
MOST_FEATURES = 1 << 20
#: The loss of rows of length one and an intercept bends by no more than a half.
STEP = 2.0

MODEL = T.StructType([
    T.StructField("term", T.StringType()), T.StructField("idf", T.DoubleType()),
    T.StructField("coefficient", T.DoubleType()),
])


def learned_terms(
    df: DataFrame, text: str, max_features: int = MAX_FEATURES, n_documents: int | None = None
) -> DataFrame:
    """``i, term, idf``: the terms with the highest counts from 1 on, the intercept at 0."""
    if not 0 < max_features <= MOST_FEATURES:
        raise ValueError(f"max_features must lie between 1 and {MOST_FEATURES}")
    n = F.lit(df.count() if n_documents is None else n_documents)
    # At most max_features rows are numbered in one task.
    order = Window.orderBy(F.desc("tf"), "term")
    found = vocabulary(df, text, max_features).select(
        F.row_number().over(order).alias("i"), "term",
        (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"),
    )
    first = df.sparkSession.createDataFrame([(0, INTERCEPT, 1.0)], "i int, term string, idf double")
    return first.unionByName(found)


def _weighted(df: DataFrame, text: str | Column, key: str, table: DataFrame) -> DataFrame:
    """``key, x`` and the table's columns: the weighted count of each term in each document."""
    words = F.concat(F.array(F.lit(INTERCEPT)), F.coalesce(terms(text), F.array().cast("array<string>")))
    uses = df.select(key, F.explode(words).alias("term"))
    # A position stands for its term and is shorter.
    columns = [c for c in table.columns if c != "term" or "i" not in table.columns]
    known = uses.join(F.broadcast(table), "term")
    counted = known.groupBy(key, *columns).agg(F.count("*").alias("tf"))
    return counted.withColumn("x", F.col("tf") * F.col("idf"))


def document_vectors(df: DataFrame, text: str | Column, key: str, table: DataFrame) -> DataFrame:
    """``key, i, w``: positions and TF-IDF weights of length one; position 0 has weight 1.

    The key must identify a document. A row holds no more cells than there are terms.
    """
    cells = _weighted(df, text, key, table.select("i", "term", "idf")).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("i", "x"))).alias("cells"),
        F.sqrt(F.sum(F.when(F.col("i") > 0, F.col("x") * F.col("x")))).alias("norm"),
    )
    weight = F.transform("cells", lambda c: F.when(c["i"] == 0, 1.0).otherwise(c["x"] / F.col("norm")))
    return cells.select(key, F.col("cells.i").alias("i"), weight.alias("w"))


def slopes(vectors: DataFrame, coefficients: DataFrame, penalty: float, n: int) -> DataFrame:
    """``coefficients`` and the slope of the penalised mean loss at ``point`` in each of them.

    ``vectors`` holds ``i, w, label``; the intercept is not penalised.
    """
    ordered = F.array_sort(F.collect_list(F.struct("i", "point")))
    at = coefficients.agg(ordered["point"].alias("at"))
    rows = vectors.join(F.broadcast(at))  # one row, at most MOST_FEATURES numbers
    parts = F.zip_with("i", "w", lambda i, w: F.get("at", i) * w)
    margin = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    rows = rows.select("i", "w", (1 / (1 + F.exp(-margin)) - F.col("label")).alias("miss"))
    cells = rows.select("miss", F.explode(F.arrays_zip("i", "w")).alias("cell"))
    sums = cells.groupBy(F.col("cell.i").alias("i")).agg(F.sum(F.col("miss") * F.col("cell.w")).alias("total"))
    drag = F.when(F.col("i") > 0, penalty * F.col("point")).otherwise(0.0)
    slope = F.coalesce(F.col("total"), F.lit(0.0)) / n + drag
    return coefficients.join(sums, "i", "left").select(*coefficients.columns, slope.alias("slope"))


def fit_rounds(
    vectors: DataFrame, table: DataFrame, rounds: int, penalty: float, n: int, tolerance: float = 0.0
) -> DataFrame:
    """``i, coefficient`` after full-batch gradient rounds with momentum, from zero.

    Each round is written, so none repeats an earlier one. With a tolerance the rounds end
    when no slope is larger.
    """
    spark = table.sparkSession
    now = table.select("i", F.lit(0.0).alias("coefficient"), F.lit(0.0).alias("point"))
    for k in range(1, rounds + 1):
        moved = F.col("point") - STEP / (1 + 2 * penalty) * F.col("slope")
        ahead = moved + (k - 1) / (k + 2) * (moved - F.col("coefficient"))
        step = slopes(vectors, now, penalty, n).select(
            "i", moved.alias("coefficient"), ahead.alias("point"), F.abs("slope").alias("size")
        )
        step = read_table(spark, write_table(step, scratch_dir(spark, "round")))
        now = step.drop("size")
        if tolerance and step.agg(F.max("size")).first()[0] <= tolerance:
            break
    return now.select("i", "coefficient")


def steepest(vectors: DataFrame, coefficients: DataFrame, penalty: float, n: int) -> DataFrame:
    """One row, ``steepest``: the largest slope; 0 at the optimum, which is the only one."""
    at = slopes(vectors, coefficients.withColumn("point", F.col("coefficient")), penalty, n)
    return at.agg(F.max(F.abs("slope")).alias("steepest"))


def fit_term_model(
    df: DataFrame, text: str, key: str, label: str, rounds: int, max_features: int = MAX_FEATURES,
    inverse_strength: float = 1.0, tolerance: float = 0.0,
) -> DataFrame:
    """``term, idf, coefficient`` of a classifier of texts with 0/1 labels."""
    spark = df.sparkSession
    n = df.count()
    table = learned_terms(df, text, max_features, n)
    table = read_table(spark, write_table(table, scratch_dir(spark, "terms")))
    rows = document_vectors(df, text, key, table).join(df.select(key, F.col(label).cast("double").alias("label")), key)
    rows = read_table(spark, write_table(rows.select("i", "w", "label"), scratch_dir(spark, "vectors")))
    fitted = fit_rounds(rows, table, rounds, 1.0 / (inverse_strength * n), n, tolerance)
    return table.join(fitted, "i").select("term", "idf", "coefficient")


def term_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The table of a fitted MLlib pipeline, whose model holds it on the driver already."""
    counts, weights, _, classifier = model.stages
    idf, coefficients = weights.getScalingVec().toArray(), classifier.coefficients.toArray()
    rows = [(INTERCEPT, 1.0, float(classifier.intercept))]
    rows += zip(counts.vocabulary, idf.tolist(), coefficients.tolist())
    return spark.createDataFrame(rows, MODEL)


def predict_by_terms(df: DataFrame, model: DataFrame, cleaned: str | Column, key: str) -> DataFrame:
    """Add ``prediction`` (0/1) and ``probability`` (array) to the table; the key identifies a row.

    A text without a known term gets the probability of the intercept alone.
    """
    first = F.col("is_first")
    table = model.withColumn("is_first", F.col("term") == INTERCEPT)
    parts = _weighted(df, cleaned, key, table.select("term", "idf", "coefficient", "is_first"))
    dot = F.sum(F.when(~first, F.col("x") * F.col("coefficient")))
    norm = F.sqrt(F.sum(F.when(~first, F.col("x") * F.col("x"))))
    margin = F.max(F.when(first, F.col("coefficient"))) + F.coalesce(dot / norm, F.lit(0.0))
    scored = parts.groupBy(key).agg(margin.alias("margin"))
    joined = df.join(scored.select(key, (1 / (1 + F.exp(-F.col("margin")))).alias("p")), key)
    return joined.select(
        *df.columns, F.when(F.col("p") > 0.5, 1).otherwise(0).alias("prediction"),
        F.array(1 - F.col("p"), F.col("p")).alias("probability"),
    )
