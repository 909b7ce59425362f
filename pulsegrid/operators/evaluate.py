"""Quality of 0/1 predictions; each function is one aggregation pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.numbers import count_where, ratio

CLASS_NAMES = ("Negative", "Positive")


def detection_columns(label: str | None, predicted: str) -> dict:
    """Aggregates of anomaly detection quality; any positive label is an anomaly.

    All NULL when there is no label column.
    """
    names = ("actual_anomalies", "true_positives", "false_positives", "false_negatives")
    if label is None:
        counts = {n: F.lit(None).cast("bigint") for n in names}
        return counts | {n: F.lit(None).cast("double") for n in ("precision", "recall")}
    actual = F.coalesce(F.col(label) > 0, F.lit(False))
    flagged, passed = F.col(predicted) == 1, F.col(predicted) == 0
    tp, fp = count_where(actual & flagged), count_where(~actual & flagged)
    fn = count_where(actual & passed)
    counts = dict(zip(names, (count_where(actual), tp, fp, fn)))
    return counts | {"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)}


def detection_metrics(
    df: DataFrame, label: str = "is_anomaly", predicted: str = "is_predicted_anomaly"
) -> DataFrame:
    measures = detection_columns(label if label in df.columns else None, predicted)
    return df.agg(*[c.alias(n) for n, c in measures.items()])


def _cells(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """One row with the four counts n<actual><predicted>."""
    return df.agg(
        *[
            count_where((F.col(label) == a) & (F.col(predicted) == p)).alias(f"n{a}{p}")
            for a in (0, 1)
            for p in (0, 1)
        ]
    )


def _scores(tp, predicted, actual):
    precision, recall = ratio(tp, predicted), ratio(tp, actual)
    return precision, recall, ratio(2 * precision * recall, precision + recall)


def binary_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """One row: accuracy, precision, recall and F1 of class 1."""
    n = {c: F.col(c) for c in ("n00", "n01", "n10", "n11")}
    precision, recall, f1 = _scores(n["n11"], n["n01"] + n["n11"], n["n10"] + n["n11"])
    accuracy = ratio(n["n00"] + n["n11"], sum(list(n.values())[1:], n["n00"]))
    return _cells(df, label, predicted).select(
        accuracy.alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1_score"),
    )


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Rows: actual 0 and 1; columns: predicted 0 and 1; empty cells are 0."""
    rows = [
        F.struct(
            F.lit(a).alias("actual"),
            F.col(f"n{a}0").alias("predicted_0"),
            F.col(f"n{a}1").alias("predicted_1"),
        )
        for a in (0, 1)
    ]
    return _cells(df, label, predicted).select(F.inline(F.array(*rows)))


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Per class and averaged: precision, recall, F1, support.

    The accuracy row carries the accuracy in ``f1_score``, as such reports print it.
    """
    cells = _cells(df, label, predicted)
    n = {c: F.col(c) for c in ("n00", "n01", "n10", "n11")}
    supports = [n["n00"] + n["n01"], n["n10"] + n["n11"]]
    predictions = [n["n00"] + n["n10"], n["n01"] + n["n11"]]
    hits = [n["n00"], n["n11"]]
    total = supports[0] + supports[1]
    scores = [_scores(h, p, s) for h, p, s in zip(hits, predictions, supports)]
    macro = [(a + b) / 2 for a, b in zip(*scores)]
    weighted = [ratio(a * supports[0] + b * supports[1], total) for a, b in zip(*scores)]
    none = F.lit(None).cast("double")

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            support.alias("support"),
        )

    rows = [row(name, *s, k) for name, s, k in zip(CLASS_NAMES, scores, supports)]
    rows.append(row("accuracy", none, none, ratio(hits[0] + hits[1], total), total))
    rows.append(row("macro avg", *macro, total))
    rows.append(row("weighted avg", *weighted, total))
    return cells.select(F.inline(F.array(*rows)))
