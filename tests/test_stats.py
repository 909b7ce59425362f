"""Validation, statistics, quantiles, sampling and evaluation."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.hashing import hash_hex
from pulsegrid.functions.numbers import status
from pulsegrid.operators import evaluate, generate, profile, quantiles, sampling, stats, validate


def telemetry(spark, rows):
    return spark.createDataFrame(
        rows,
        "seq long, timestamp timestamp_ntz, temperature double, voltage double, current double,"
        " angular_velocity double, solar_power double, is_anomaly int",
    )


def reading(seq, minute, temperature=20.0, voltage=28.0, label=0):
    ts = None if minute is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)
    return (seq, ts, temperature, voltage, 5.0, 0.1, 140.0, label)


def test_required_columns(spark):
    df = telemetry(spark, [reading(0, 0)])
    assert validate.require_columns(df) is df
    with pytest.raises(ValueError, match="voltage"):
        validate.require_columns(df.drop("voltage"))


def test_null_counts_take_nan_as_missing(spark):
    df = telemetry(spark, [reading(0, 0, float("nan")), reading(1, None, None)])
    counts = {r.column: r.n_missing for r in validate.null_counts(df).collect()}
    assert (counts["temperature"], counts["timestamp"], counts["(total)"]) == (2, 1, 3)


def test_range_check_is_inclusive(spark):
    df = telemetry(spark, [reading(0, 0, -50.0, 20.0), reading(1, 1, 100.0, 35.1)])
    checks = {r.column: (r.ok, r.n_outside) for r in validate.range_check(df).collect()}
    assert checks == {"temperature": (True, 0), "voltage": (False, 1)}


@pytest.mark.parametrize(
    ("minutes", "expected"),
    [
        ([0, 1, 1, 2, 3, 5, 8], True),
        ([0, 1, 2, 1, 3], False),
        ([0, 1, 2, 3, 2], False),  # falls between buckets of two
        ([0, None, 2], False),
        ([], True),
    ],
)
def test_is_sorted(spark, minutes, expected):
    df = telemetry(spark, [reading(i, m) for i, m in enumerate(minutes)]).repartition(3)
    assert validate.is_sorted(df, rows_per_bucket=2).first().is_sorted is expected


def test_validate_lists_all_checks(spark):
    rows = validate.validate(telemetry(spark, [reading(0, 0)])).collect()
    assert {r.check for r in rows} == {"missing_values", "range", "sorted"}
    assert all(r.ok for r in rows)


def test_status_limits(spark):
    rates = spark.createDataFrame([(0.99,), (1.0,), (4.99,), (5.0,)], "r double")
    got = [r[0] for r in rates.orderBy("r").select(status(F.col("r"))).collect()]
    assert got == ["NOMINAL", "CAUTION", "CAUTION", "ALERT"]


def test_simple_report_counts_a_row_twice(spark):
    rows = [reading(i, i, 20.0 + i % 2, 28.0 + i % 2) for i in range(99)]
    df = telemetry(spark, [*rows, reading(99, 99, 500.0, 0.0), reading(100, 100, None, None)])
    report = stats.simple_report(df).first()
    assert (report.total_samples, report.temp_anomalies, report.voltage_anomalies) == (101, 1, 1)
    assert report.anomaly_rate_pct == pytest.approx(200 / 101)
    assert report.status == "CAUTION"
    assert [r.seq for r in stats.sigma_filter(df, "temperature").collect()] == [99]
    flags = stats.flag_outliers(df).filter("temperature_outlier or voltage_outlier")
    assert flags.count() == 1


def test_reports_on_an_empty_table(spark):
    report = stats.simple_report(telemetry(spark, [])).first()
    assert (report.total_samples, report.anomaly_rate_pct) == (0, 0.0)


@pytest.mark.parametrize("limit", [1, 10, 1000])
@pytest.mark.parametrize("shape", ["normal", "ties", "constant", "tiny", "wide"])
def test_exact_quantiles_match_numpy(spark, limit, shape):
    rng = np.random.default_rng(7)
    values = {
        "normal": rng.normal(size=700),
        "ties": rng.integers(0, 5, 700).astype(float),
        "constant": np.full(50, 3.5),
        "tiny": np.array([1.0, 2.0]),
        "wide": np.exp(rng.normal(size=300) * 90) * np.where(rng.random(300) < 0.5, -1, 1),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    wanted = [0.0, 0.05, 0.5, 0.75, 1.0]
    got = quantiles.exact_quantiles(df, ["v"], wanted, limit)["v"]
    np.testing.assert_allclose(got, np.quantile(values, wanted), atol=1e-12)


def test_quantile_columns_agree_at_any_bracket_size(spark):
    df = spark.range(1001).select((F.col("id") * 1.5).alias("v"), (-F.col("id")).alias("w"))
    for n in (1, 10, 10_000):
        got = quantiles.quantile_columns(df, ["v", "w"], [0.05, 0.5], left_rows=n)
        row = df.agg(got["v"].alias("v"), got["w"].alias("w")).first()
        assert (row.v, row.w) == ([75.0, 750.0], [-950.0, -500.0])
    assert quantiles.exact_quantiles(df.limit(0), ["v"], [0.5]) == {"v": [None]}


@pytest.mark.parametrize("limit", [1, 1000])
def test_quantiles_of_infinite_and_nan_values(spark, limit):
    values = [float("-inf")] * 3 + [float(k) for k in range(20)] + [float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    low, middle, top = quantiles.exact_quantiles(df, ["v"], [0.0, 0.5, 1.0], limit)["v"]
    assert (low, middle) == (float("-inf"), 9.0) and np.isnan(top)


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "x double")
    row = profile.describe(df, ["x"]).first()
    assert (row["count"], row.p25, row.p50, row.p75, row.max) == (3, 1.5, 2.0, 3.0, 4.0)
    assert profile.feature_summary(df, df.withColumn("y", F.lit(1))) == {
        "original": 1, "new": 1, "total": 2,
    }


@pytest.mark.parametrize("n", [0, 1, 19, 20, 999])
def test_exact_sizes(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    assert sampling.exact_sample(df, 0.05, "k").count() == int(n * 0.05)
    train, test = sampling.exact_split(df, 0.2, "k")
    assert test.count() == math.ceil(n * 0.2)
    assert sorted(r.k for r in train.union(test).collect()) == list(range(n))


def test_sample_depends_on_key_and_seed_only(spark):
    df = spark.range(500).withColumnRenamed("id", "k")

    def pick(frame, seed=42):
        return {r.k for r in sampling.exact_sample(frame, 0.1, "k", seed).collect()}

    assert pick(df) == pick(df.repartition(7))
    assert pick(df) != pick(df, 43)


def test_sample_refuses_repeated_keys_on_its_edge(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("k"))
    with pytest.raises(ValueError, match="do not identify rows"):
        sampling.exact_sample(df, 0.05, "k")


def test_hash_tells_missing_parts_apart(spark):
    rows = spark.createDataFrame([(1, None), (None, 1)], "a int, b int")
    assert len({r.h for r in rows.select(hash_hex(0, "a", "b").alias("h")).collect()}) == 2


def test_generated_telemetry(spark):
    df = generate.generate_telemetry(spark, days=2).cache()
    label = generate.label_breakdown(df).first()
    assert (label.normal, label.anomalous, label.anomalous_pct) == (2736, 144, 5.0)
    first, second = (r.timestamp for r in profile.preview(df, n=2).collect())
    assert (first, second) == (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 1))
    normal = df.filter("is_anomaly = 0").agg(
        *[F.avg(c).alias(c) for c in generate.NORMAL_READINGS],
        *[F.stddev(c).alias(f"{c}_std") for c in generate.NORMAL_READINGS],
    ).first()
    for c, (mean, std) in generate.NORMAL_READINGS.items():
        assert normal[c] == pytest.approx(mean, abs=std / 8)
        assert normal[f"{c}_std"] == pytest.approx(std, rel=0.1)
    faults = " or ".join(f"{c} between {lo} and {hi}" for _, c, lo, hi in generate.FAULTS)
    assert df.filter("is_anomaly = 1").filter(faults).count() == 144


def pairs(spark, rows):
    return spark.createDataFrame(rows, "y int, p int")


def test_metrics_by_hand(spark):
    df = pairs(spark, [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4)
    m = evaluate.binary_metrics(df, "y", "p").first()
    assert (m.accuracy, m.precision, m.recall) == (0.7, 0.6, 0.75)
    assert m.f1_score == pytest.approx(2 / 3)
    cells = evaluate.confusion_matrix(df, "y", "p").orderBy("actual").collect()
    assert [tuple(r) for r in cells] == [(0, 4, 2), (1, 1, 3)]
    report = {r["class"]: r for r in evaluate.classification_report(df, "y", "p").collect()}
    assert report["Negative"].precision == pytest.approx(0.8)
    assert report["accuracy"].f1_score == pytest.approx(0.7)
    assert report["weighted avg"].recall == pytest.approx((6 * 4 / 6 + 4 * 0.75) / 10)


def test_metrics_with_zero_denominators(spark):
    df = pairs(spark, [(0, 0), (0, 0)])
    m = evaluate.binary_metrics(df, "y", "p").first()
    assert (m.accuracy, m.precision, m.recall, m.f1_score) == (1.0, 0.0, 0.0, 0.0)
    cells = evaluate.confusion_matrix(df, "y", "p").orderBy("actual").collect()
    assert [tuple(r) for r in cells] == [(0, 2, 0), (1, 0, 0)]


def test_detection_metrics(spark):
    rows = [(2, 1), (1, 0), (0, 1), (0, 0)]
    df = spark.createDataFrame(rows, "is_anomaly int, is_predicted_anomaly int")
    row = evaluate.detection_metrics(df).first()
    assert tuple(row) == (2, 1, 1, 1, 0.5, 0.5)
    assert tuple(evaluate.detection_metrics(df.drop("is_anomaly")).first()) == (None,) * 6


def test_short_doubles_leave_what_has_no_six_places(spark):
    from pulsegrid.plans.catalog import rounded

    values = [1e13, float("inf"), float("-inf"), float("nan"), 1.23456749, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = [r.x for r in rounded(df).collect()]
    assert found[:3] == values[:3] and found[3] != found[3] and found[4:] == [1.234567, None]
