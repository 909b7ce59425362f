"""The classifier as tables against numpy, MLlib and awkward texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import termmodel
from pulsegrid.operators.sentiment import fit_sentiment, predict
from pulsegrid.plans import sentiment
from pulsegrid.sources.tables import read_table, write_table

WORDS = [f"{a}{b}x" for a in "bcdfg" for b in "aeiou"]


@pytest.fixture(scope="module")
def reviews(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(120):
        good = k % 3 > 0
        words = rng.choice(WORDS[:14] if good else WORDS[8:], int(rng.integers(1, 12)))
        rows.append((k, " ".join(words), int(good)))
    rows += [(200, "", 1), (201, "a b c", 0), (202, None, 1), (203, "zzz yyy", 0)]
    return spark.createDataFrame(rows, "k long, text string, label int").cache()


@pytest.fixture(scope="module")
def fitted(reviews):
    return fit_sentiment(reviews.fillna("", ["text"]), "text", max_features=60)


@pytest.fixture(scope="module")
def table(spark, reviews, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("terms"))
    learned = termmodel.learned_terms(reviews, "text", 60)
    return read_table(spark, write_table(learned, f"{path}/t"))


def dense(reviews, table):
    """The document matrix with the intercept first, and the labels, in key order."""
    width = table.count()
    rows = termmodel.document_vectors(reviews, "text", "k", table).orderBy("k").collect()
    x = np.zeros((len(rows), width))
    for at, r in enumerate(rows):
        x[at, r.i] = r.w
    labels = np.array([r.label for r in reviews.orderBy("k").collect()], float)
    return x, labels


def test_vectors_equal_the_mllib_stages(reviews, fitted, table):
    x, _ = dense(reviews, table)
    staged = reviews.fillna("", ["text"]).withColumn("terms", termmodel.terms("text"))
    for stage in fitted.stages[:-1]:
        staged = stage.transform(staged)
    theirs = np.array([r.features.toArray() for r in staged.orderBy("k").collect()])
    order = {r.term: r.i for r in table.collect()}
    places = [order[t] for t in fitted.stages[0].vocabulary]
    assert np.allclose(x[:, places], theirs) and (x[:, 0] == 1).all()


def test_slopes_and_rounds_equal_numpy(spark, reviews, table):
    x, y = dense(reviews, table)
    n, penalty = len(y), 1 / len(y)
    rows = termmodel.document_vectors(reviews, "text", "k", table)
    rows = rows.join(reviews.select("k", F.col("label").cast("double").alias("label")), "k")
    b = p = np.zeros(x.shape[1])
    for k in range(1, 5):
        slope = x.T @ (1 / (1 + np.exp(-x @ p)) - y) / n + penalty * np.r_[0, p[1:]]
        moved = p - termmodel.STEP / (1 + 2 * penalty) * slope
        b, p = moved, moved + (k - 1) / (k + 2) * (moved - b)
    found = termmodel.fit_rounds(rows, table, 4, penalty, n).orderBy("i").collect()
    assert np.allclose([r.coefficient for r in found], b, atol=1e-12)
    at = spark.createDataFrame(list(enumerate(b.tolist())), "i int, coefficient double")
    slope = x.T @ (1 / (1 + np.exp(-x @ b)) - y) / n + penalty * np.r_[0, b[1:]]
    assert termmodel.steepest(rows, at, penalty, n).first()[0] == pytest.approx(np.abs(slope).max())


def test_rounds_reach_the_fit_of_the_solver(reviews, fitted, table):
    """The optimum is the only one, so both ways must end near it."""
    n = reviews.count()
    rows = termmodel.document_vectors(reviews, "text", "k", table)
    rows = rows.join(reviews.select("k", F.col("label").cast("double").alias("label")), "k").cache()
    ours = termmodel.fit_rounds(rows, table, 60, 1 / n, n, tolerance=2e-3)
    slope = termmodel.steepest(rows, ours, 1 / n, n).first()[0]
    assert slope <= 4e-3
    theirs = fitted.stages[-1].coefficients.toArray()
    by_term = {r.term: r.coefficient for r in table.join(ours, "i").collect()}
    mine = np.array([by_term[t] for t in fitted.stages[0].vocabulary])
    assert np.abs(mine - theirs).max() < 0.2 * np.abs(theirs).max()


def test_table_of_a_fit_predicts_what_the_fit_does(spark, reviews, fitted, folder):
    path = write_table(termmodel.term_table(spark, fitted), f"{folder}/terms")
    model = read_table(spark, path)
    ours = {r.k: r for r in termmodel.predict_by_terms(reviews, model, "text", "k").collect()}
    theirs = predict(reviews.fillna("", ["text"]), fitted, "text").collect()
    assert len(ours) == len(theirs) == 124
    for r in theirs:
        assert ours[r.k].prediction == r.prediction
        assert np.allclose(ours[r.k].probability, r.probability, atol=1e-9)


def test_texts_without_known_terms_get_the_intercept(spark, fitted, reviews):
    model = termmodel.term_table(spark, fitted)
    p = 1 / (1 + np.exp(-fitted.stages[-1].intercept))
    found = termmodel.predict_by_terms(reviews.filter("k >= 200"), model, "text", "k").collect()
    assert len(found) == 4
    for r in found:
        assert r.k == 203 or r.probability[1] == pytest.approx(p)
    assert termmodel.predict_by_terms(reviews.limit(0), model, "text", "k").count() == 0


def test_trained_tables_are_stored(spark, reviews, folder):
    texts = reviews.select(
        "k", F.coalesce("text", F.lit("")).alias("review"),
        F.when(F.col("label") == 1, "positive").otherwise("negative").alias("sentiment"),
    )
    terms, holdout = sentiment.train_term_model(texts, "k", folder, rounds=3)
    assert holdout.count() == 25 and read_table(spark, f"{folder}/train").count() == 99
    assert terms.columns == ["term", "idf", "coefficient"]
    scored = sentiment.predict_by_table(texts.select("k", "review"), terms, "k")
    assert scored.columns == ["k", "review", "sentiment", "confidence"] and scored.count() == 124
    assert scored.filter("confidence < 0.5").count() == 0


def test_feature_bound_is_checked(reviews):
    for wrong in (0, termmodel.MOST_FEATURES + 1):
        with pytest.raises(ValueError, match="max_features"):
            termmodel.learned_terms(reviews, "text", wrong)
