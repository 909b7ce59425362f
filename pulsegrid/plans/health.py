"""Telemetry health from raw readings to reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.numbers import count_where, percent, status
from pulsegrid.operators.evaluate import detection_columns
from pulsegrid.operators.features import engineer_features
from pulsegrid.operators.iforest import (
    CONTAMINATION,
    contamination_threshold,
    fit_iforest,
    predict_columns,
    score,
)
from pulsegrid.operators.resample import HOUR, dedupe_first, resample_mean
from pulsegrid.operators.series import Axis, ffill
from pulsegrid.operators.stats import averages, simple_report
from pulsegrid.operators.validate import PLAUSIBLE, require_columns, validate
from pulsegrid.schemas import LABEL, METRICS, TIMESTAMP
from pulsegrid.sources.tables import read_table, write_report, write_table


def clean_telemetry(
    raw: DataFrame, seq: str = "seq", keys: tuple[str, ...] = (), step: int = HOUR,
    max_bins: int | None = None,
) -> DataFrame:
    """Drop duplicate timestamps, resample to gap-free means, fill forward."""
    label = LABEL if LABEL in raw.columns else None
    columns = [*METRICS, label] if label else list(METRICS)
    deduped = dedupe_first(raw.select(seq, *keys, TIMESTAMP, *columns), [*keys, TIMESTAMP], seq)
    hourly = resample_mean(
        deduped, METRICS, step=step, keys=keys, label=label, span=raw, max_bins=max_bins
    )
    return ffill(hourly, axis=Axis(TIMESTAMP, tuple(keys), step))


def ml_report(scored: DataFrame, label: str = LABEL) -> DataFrame:
    """Health report of scored telemetry: one row, one aggregation pass."""
    n = F.count("*")
    flagged = count_where(F.col("is_predicted_anomaly") == 1)
    quality = detection_columns(label if label in scored.columns else None, "is_predicted_anomaly")
    return scored.agg(
        n.alias("total_samples"),
        F.min(TIMESTAMP).alias("first_timestamp"),
        F.max(TIMESTAMP).alias("last_timestamp"),
        *averages(),
        flagged.alias("predicted_anomalies"),
        (n - flagged).alias("predicted_normal"),
        percent(flagged, n).alias("anomaly_rate_pct"),
        *[c.alias(name) for name, c in quality.items()],
    ).withColumn("status", status(F.col("anomaly_rate_pct")))


def run_simple_health(
    spark: SparkSession,
    path: str,
    out: str | None = None,
    fmt: str = "parquet",
    schema=None,
    limits: Mapping[str, tuple[float, float]] = PLAUSIBLE,
) -> dict[str, DataFrame]:
    """Load, validate, analyse, report; no model."""
    raw = read_table(spark, path, schema, fmt, file_order="seq")
    checks = validate(raw, limits=limits)
    report = simple_report(raw)
    if out:
        write_report(report, out)
    return {"checks": checks, "report": report}


def run_ml_health(
    spark: SparkSession,
    path: str,
    out: str,
    fmt: str = "parquet",
    schema=None,
    keys: tuple[str, ...] = (),
    handle_invalid: str = "error",
    contamination: float = CONTAMINATION,
    seq: str | None = None,
) -> dict[str, DataFrame]:
    """Clean, derive features, fit, score, report.

    Each stage table is written once, so later stages neither recompute earlier
    ones nor depend on the executors that ran them. ``seq`` names an integer column
    of the table that orders its rows; without one they go in file order, which makes
    dropping duplicates a sort.
    """
    order = "seq" if seq is None else None
    raw = require_columns(read_table(spark, path, schema, fmt, file_order=order))
    axis = Axis(TIMESTAMP, tuple(keys), dense=True)
    cleaned = read_table(
        spark, write_table(clean_telemetry(raw, seq or "seq", tuple(keys)), f"{out}/cleaned")
    )
    features = read_table(
        spark, write_table(engineer_features(cleaned, axis), f"{out}/features")
    )
    model = fit_iforest(
        features, key=[*keys, TIMESTAMP], contamination=None, handle_invalid=handle_invalid
    )
    # Scoring is the costly part: rows are scored once, and the offset comes from the result.
    scores = read_table(
        spark, write_table(score(features, model, handle_invalid), f"{out}/scored")
    )
    model.params["contamination"] = contamination
    model.offset = contamination_threshold(scores, contamination).first()["threshold"]
    model.save(spark, f"{out}/model")
    scored = scores.withColumns(predict_columns("anomaly_score", F.lit(model.offset)))
    report = ml_report(scored)
    write_report(report, out, "ml_health_report")
    return {"cleaned": cleaned, "features": features, "scored": scored, "report": report}
