"""Cleaning, n-grams, TF-IDF and the classifier against plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import text
from pulsegrid.operators import sentiment as model_ops
from pulsegrid.operators import textfeatures as tf
from pulsegrid.plans import sentiment

TEXTS = [
    "Great<br />movie! Don't 4ever",
    "a < b > c and <b>bold</b>",
    "tag <with\rreturn> kept? <with\nnewline> yes",
    "no break café naïve \x1c sep   wide",
    "",
    "<<nested> tags>>",
    "UPPER lower MiXeD x y zz",
    "tab\there\x0bvertical\x85next",
]


def plain_clean(s):
    s = re.sub(r"<.*?>", "", s.lower())
    return re.sub(r"[^a-zA-Z\s]", "", s)


def plain_terms(s):
    words = re.findall(r"(?u)\b\w\w+\b", s)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, review string")


def test_clean_text(docs):
    cleaned = tf.clean_reviews(docs).orderBy("id").collect()
    assert [r.cleaned_review for r in cleaned] == [plain_clean(s) for s in TEXTS]
    assert cleaned[0].cleaned_review.startswith("greatmovie dont ever")


def test_terms(docs):
    cleaned = tf.clean_reviews(docs).select("id", tf.terms("cleaned_review").alias("t"))
    got = [r.t for r in cleaned.orderBy("id").collect()]
    assert got == [plain_terms(plain_clean(s)) for s in TEXTS]


def test_trigrams(spark):
    words = spark.createDataFrame([(["aa", "bb", "cc"],), (["aa"],), ([],)], "w array<string>")
    got = [r[0] for r in words.select(text.ngrams(F.col("w"), (3,))).collect()]
    assert got == [["aa bb cc"], [], []]


def test_map_label_leaves_others_missing(spark):
    df = spark.createDataFrame([("positive",), ("negative",), ("odd",), (None,)], "s string")
    got = [r.label for r in model_ops.binary_labels(df, "s").collect()]
    assert got == [1, 0, None, None]


def corpus(spark, n=60):
    rng = np.random.default_rng(4)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)]
    rows = []
    for i in range(n):
        label = int(rng.random() < 0.5)
        pool = words[: 24] if label else words[12:]
        rows.append((i, " ".join(rng.choice(pool, size=rng.integers(0, 12))), label))
    return rows, spark.createDataFrame(rows, "id int, cleaned_review string, label int")


def plain_tfidf(texts, size):
    counts = [Counter(plain_terms(t)) for t in texts]
    total, seen = Counter(), Counter()
    for c in counts:
        total.update(c)
        seen.update(c.keys())
    kept = sorted(total, key=lambda t: (-total[t], t))[:size]
    matrix = np.zeros((len(texts), len(kept)))
    for i, c in enumerate(counts):
        for j, t in enumerate(kept):
            matrix[i, j] = c[t] * (math.log((1 + len(texts)) / (1 + seen[t])) + 1)
        length = np.linalg.norm(matrix[i])
        matrix[i] /= length or 1.0
    return kept, total, seen, matrix


def test_vocabulary_and_tfidf(spark):
    rows, df = corpus(spark)
    kept, total, seen, matrix = plain_tfidf([r[1] for r in rows], 50)
    vocab = tf.vocabulary(df, "cleaned_review", 50).collect()
    assert [tuple(r) for r in vocab] == [(t, total[t], seen[t]) for t in kept]
    cells = tf.tfidf(df, "cleaned_review", "id", 50).collect()
    assert len(cells) == np.count_nonzero(matrix)
    for r in cells:
        assert r.weight == pytest.approx(matrix[r.id, kept.index(r.term)])


def test_classifier_reaches_the_penalised_optimum(spark):
    rows, df = corpus(spark)
    kept, _, _, x = plain_tfidf([r[1] for r in rows], 50)
    y = np.array([r[2] for r in rows], dtype=float)
    weights, intercept = np.zeros(x.shape[1]), 0.0
    for _ in range(50):  # Newton steps on 0.5 |w|^2 + sum of log-losses
        p = 1 / (1 + np.exp(-(x @ weights + intercept)))
        z = np.hstack([x, np.ones((len(y), 1))])
        penalty = np.diag([1.0] * x.shape[1] + [0.0])
        gradient = z.T @ (p - y) + penalty @ np.append(weights, intercept)
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty, gradient)
        weights, intercept = weights - step[:-1], intercept - step[-1]
    model = model_ops.fit_sentiment(df, max_features=50)
    fitted = model.stages[-1]
    np.testing.assert_allclose(fitted.coefficients.toArray(), weights, atol=5e-3)
    assert fitted.intercept == pytest.approx(intercept, abs=5e-3)
    scored = model_ops.predict(df, model, "cleaned_review").orderBy("id").collect()
    p = 1 / (1 + np.exp(-(x @ weights + intercept)))
    np.testing.assert_allclose([r.probability[1] for r in scored], p, atol=2e-3)


def test_missing_labels_are_refused(spark):
    _, df = corpus(spark)
    with pytest.raises(ValueError, match="1 rows without a label"):
        model_ops.fit_sentiment(df.withColumn("label", F.when(F.col("id") != 3, F.col("label"))))


def test_confidence_is_that_of_the_predicted_class(spark):
    df = spark.createDataFrame([(0, [0.8, 0.2]), (1, [0.3, 0.7])], "prediction int, probability array<double>")
    got = [tuple(r) for r in model_ops.sentiment_columns(df).collect()]
    assert got == [("negative", 0.8), ("positive", 0.7)]


def test_train_evaluate_predict(spark, folder):
    rows, _ = corpus(spark, 100)
    reviews = spark.createDataFrame(
        [(i, t.upper() + "<br/>", "positive" if y else "negative") for i, t, y in rows],
        "id int, review string, sentiment string",
    )
    results = sentiment.run_sentiment(reviews, "id", folder)
    assert results["metrics"].first().accuracy > 0.7
    report = {r["class"]: r.support for r in results["report"].collect()}
    assert report["accuracy"] == 20
    predictions = results["predictions"]
    assert predictions.columns == ["id", "review", "sentiment", "confidence"]
    assert predictions.filter("confidence between 0.5 and 1").count() == 100
