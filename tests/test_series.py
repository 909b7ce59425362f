"""Fills, windows and resampling against pandas, with segments short enough to matter."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import features, resample, series, validate

START = pd.Timestamp("2024-01-01")
HOT, SHORT, LONE = 90, 13, 1  # rows of the series; one holds most of the table


def gappy_frame(seed=0):
    rng = np.random.default_rng(seed)
    parts = []
    for key, n in ((1, HOT), (2, SHORT), (None, 40), (3, LONE)):
        part = pd.DataFrame(
            {
                "k": key,
                "timestamp": START + pd.to_timedelta(np.arange(n), unit="h"),
                "a": np.where(rng.random(n) < 0.6, np.nan, rng.normal(size=n)),
                "b": np.where(rng.random(n) < 0.95, np.nan, rng.normal(size=n)),
                "c": np.nan,
            }
        )
        parts.append(part)
    frame = pd.concat(parts, ignore_index=True).astype({"k": float})
    frame.loc[frame["k"] == 1, "b"] = np.where(np.arange(HOT) == 3, 7.0, np.nan)
    return frame


SCHEMA = "k double, timestamp timestamp_ntz, a double, b double, c double"


def to_spark(spark, frame, schema=SCHEMA):
    names = [f.split()[0] for f in schema.split(", ")]
    rows = [
        tuple(None if pd.isna(v) else (v.to_pydatetime() if isinstance(v, pd.Timestamp) else v) for v in r)
        for r in frame[names].itertuples(index=False)
    ]
    return spark.createDataFrame(rows, schema).repartition(5)


def as_pandas(df, by):
    frame = df.toPandas()
    return frame.sort_values(by, na_position="last", ignore_index=True)


def assert_same(ours, expected, columns):
    for c in columns:
        np.testing.assert_allclose(
            ours[c].to_numpy(dtype=float), expected[c].to_numpy(dtype=float), atol=1e-9, err_msg=c
        )


@pytest.mark.parametrize("segment", [4, 7, 1000])
@pytest.mark.parametrize("forward", [True, False])
def test_fill_matches_pandas(spark, segment, forward):
    frame = gappy_frame()
    axis = series.Axis(keys=("k",), segment=segment)
    fill = series.ffill if forward else series.bfill
    ours = as_pandas(fill(to_spark(spark, frame), axis=axis), ["k", "timestamp"])
    expected = frame.sort_values(["k", "timestamp"], ignore_index=True)
    grouped = expected.groupby("k", dropna=False)[["a", "b", "c"]]
    expected[["a", "b", "c"]] = grouped.ffill() if forward else grouped.bfill()
    assert len(ours) == len(expected)
    assert_same(ours, expected, ["a", "b", "c"])


def test_fill_without_keys_and_with_gaps(spark):
    frame = gappy_frame().query("k == 1").iloc[::3]
    axis = series.Axis(segment=5)
    ours = as_pandas(series.ffill(to_spark(spark, frame), axis=axis), ["timestamp"])
    assert_same(ours, frame.ffill(), ["a", "b"])


@pytest.mark.parametrize("segment", [24, 30, 1000])
def test_rolling_and_diff_match_pandas(spark, segment):
    frame = gappy_frame(1)
    axis = series.Axis(keys=("k",), segment=segment)
    df = to_spark(spark, frame)
    df = series.rolling_mean(df, "a", "mean", 24, axis)
    df = series.rolling_std(df, "a", "std", 24, axis)
    df = series.diff(df, "a", "change", axis)
    ours = as_pandas(df, ["k", "timestamp"])
    expected = frame.sort_values(["k", "timestamp"], ignore_index=True)
    grouped = expected.groupby("k", dropna=False)["a"]
    expected["mean"] = grouped.transform(lambda s: s.rolling(24, min_periods=1).mean())
    expected["std"] = grouped.transform(lambda s: s.rolling(24, min_periods=1).std())
    expected["change"] = grouped.transform(lambda s: s.diff())
    assert len(ours) == len(expected)
    assert_same(ours, expected, ["mean", "std", "change"])


def test_window_longer_than_segment_is_refused(spark):
    with pytest.raises(ValueError, match="shorter"):
        series.rolling_mean(to_spark(spark, gappy_frame()), "a", "m", 24, series.Axis(segment=10))


@pytest.mark.parametrize("segment", [4, 7, 1000])
def test_rolling_and_diff_count_rows_on_a_gapped_axis(spark, segment):
    at = [5, 6, 20, 21, 22, 31, 90, 91]
    squares, holes = [float(x) ** 2 for x in at], [1.0, None] * 4
    frame = pd.DataFrame({"i": at, "a": squares, "b": holes})
    df = spark.createDataFrame(list(zip(at, squares, holes)), "i long, a double, b double")
    axis = series.Axis(order="i", segment=segment)
    df = series.rolling_mean(df, ["a", "b"], ["ma", "mb"], 3, axis)
    ours = as_pandas(series.diff(df, "a", "change", axis), ["i"])
    np.testing.assert_allclose(ours["ma"], frame["a"].rolling(3, min_periods=1).mean())
    np.testing.assert_allclose(ours["mb"], frame["b"].rolling(3, min_periods=1).mean())
    np.testing.assert_allclose(ours["change"].to_numpy(float), frame["a"].diff().to_numpy())


def test_ordinal_makes_irregular_rows_dense(spark):
    frame = gappy_frame().query("k == 1").sample(60, random_state=3)
    axis = series.Axis(segment=7)
    dense = series.with_ordinal(to_spark(spark, frame), axis, "i")
    rolled = series.rolling_mean(dense, "a", "mean", 5, series.Axis(order="i", segment=8))
    ours = as_pandas(rolled, ["timestamp"])
    expected = frame.sort_values("timestamp")
    assert list(ours["i"]) == list(range(60))
    mean = expected["a"].rolling(5, min_periods=1).mean()
    np.testing.assert_allclose(ours["mean"].to_numpy(float), mean.to_numpy(), atol=1e-9)


def test_engineer_features_matches_pandas(spark):
    rng = np.random.default_rng(5)
    n = 120
    frame = pd.DataFrame(rng.normal(size=(n, 5)), columns=list("tvcws"))
    frame.columns = ["temperature", "voltage", "current", "angular_velocity", "solar_power"]
    frame.iloc[:3, 1] = np.nan
    frame.insert(0, "timestamp", START + pd.to_timedelta(np.arange(n), unit="h"))
    expected = frame.copy()
    rolled = expected["temperature"].rolling(24, min_periods=1)
    expected["temp_rolling_mean"], expected["temp_rolling_std"] = rolled.mean(), rolled.std()
    for c in ("voltage", "current"):
        expected[f"{c}_rolling_mean"] = expected[c].rolling(24, min_periods=1).mean()
    expected["temp_change"] = expected["temperature"].diff()
    expected["voltage_change"] = expected["voltage"].diff()
    expected["power"] = expected["voltage"] * expected["current"]
    expected = expected.bfill()
    schema = ", ".join(
        f"{c} {'timestamp_ntz' if c == 'timestamp' else 'double'}" for c in frame.columns
    )
    df = features.engineer_features(to_spark(spark, frame, schema), series.Axis(segment=25))
    assert df.columns == list(expected.columns)
    assert_same(as_pandas(df, ["timestamp"]), expected, expected.columns[1:])


def raw(spark, rows):
    return spark.createDataFrame(
        rows, "seq long, timestamp timestamp_ntz, x double, is_anomaly int"
    )


def at(hour, minute=0, day=1):
    return dt.datetime(2024, 1, day, hour, minute)


def test_dedupe_keeps_first_in_file_order(spark):
    rows = [(3, at(0), None, 0), (1, at(0), 5.0, 1), (2, at(1), 6.0, 0), (4, None, 1.0, 0), (5, None, 2.0, 0)]
    kept = resample.dedupe_first(raw(spark, rows).repartition(3), ["timestamp"])
    assert sorted((r.seq, r.x) for r in kept.collect()) == [(1, 5.0), (2, 6.0), (4, 1.0)]


def test_dedupe_keeps_a_missing_value_that_comes_first(spark):
    rows = [(1, at(0), None, 0), (2, at(0), 5.0, 1)]
    assert resample.dedupe_first(raw(spark, rows), ["timestamp"]).first().x is None


def test_resample_fills_hours_and_fixes_labels(spark):
    rows = [
        (1, at(1, 10), 1.0, 0),
        (2, at(1, 59), 3.0, 1),
        (3, at(4, 0), None, 0),
        (4, None, 100.0, 1),
    ]
    hourly = resample.resample_mean(raw(spark, rows), ["x"], label="is_anomaly")
    got = [(r.timestamp.hour, r.x, r.is_anomaly) for r in hourly.orderBy("timestamp").collect()]
    assert got == [(1, 2.0, 1), (2, None, 0), (3, None, 0), (4, None, 0)]
    assert dict(hourly.dtypes)["timestamp"] == "timestamp_ntz"


def test_resample_matches_pandas_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(resample, "BINS_PER_BLOCK", 5)
    rng = np.random.default_rng(2)
    times = START + pd.to_timedelta(np.sort(rng.integers(0, 60 * 70, 50)), unit="min")
    frame = pd.DataFrame({"timestamp": times, "x": rng.normal(size=50)})
    df = spark.createDataFrame(
        [(t.to_pydatetime(), x) for t, x in frame.itertuples(index=False)],
        "timestamp timestamp_ntz, x double",
    )
    ours = as_pandas(resample.resample_mean(df, ["x"]), ["timestamp"])
    expected = frame.set_index("timestamp").resample("1h").mean().reset_index()
    assert list(ours["timestamp"]) == list(expected["timestamp"])
    assert_same(ours, expected, ["x"])


def test_spine_guard(spark):
    rows = [(1, at(0), 1.0, 0), (2, at(5), 1.0, 0)]
    assert resample.bin_spine(raw(spark, rows), max_bins=6).count() == 6
    with pytest.raises(Exception, match="longer than 5 bins"):
        resample.bin_spine(raw(spark, rows), max_bins=5).collect()


def test_resample_does_not_depend_on_the_time_zone(spark):
    rows = [(i, dt.datetime(2024, 3, 31, h, 30), float(h), 0) for i, h in enumerate((0, 1, 2, 3, 4))]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        hourly = resample.resample_mean(raw(spark, rows), ["x"])
        filled = series.ffill(hourly, axis=series.Axis(segment=2))
        got = [(r.timestamp.hour, r.x) for r in filled.orderBy("timestamp").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [(h, float(h)) for h in range(5)]


def test_parse_ts(spark):
    text = spark.createDataFrame([("2024-01-01 00:00:05",), ("nonsense",)], "timestamp string")
    parsed = resample.parse_ts(text, strict=False).collect()
    assert [r.timestamp for r in parsed] == [dt.datetime(2024, 1, 1, 0, 0, 5), None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        resample.parse_ts(text).collect()


def test_fill_computes_its_input_once(spark):
    """Both branches of a fill read one shuffle."""
    frame = to_spark(spark, gappy_frame())
    df = series.ffill(frame.groupBy("k", "timestamp").agg(F.max("a").alias("a")), axis=series.Axis(keys=("k",)))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("segment,fan", [(1, 2), (3, 2), (5, 3)])
@pytest.mark.parametrize("forward", [True, False])
def test_fill_carries_between_groups_of_segments(spark, segment, fan, forward):
    """Gaps longer than a group of segments, with and without keys."""
    values = [None] * 5 + [1.0] + [None] * 40 + [2.0, None, 3.0] + [None] * 30
    rows = [(k, i, None if v is None else v + k, float(i)) for k in (0, 1) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k long, i long, a double, b double").repartition(5)
    fill = series.ffill if forward else series.bfill
    for keys, part in ((("k",), df), ((), df.filter("k = 0"))):
        axis = series.Axis(order="i", keys=keys, segment=segment, fan=fan)
        ours = as_pandas(fill(part, axis=axis), ["k", "i"])
        expected = part.toPandas().sort_values(["k", "i"], ignore_index=True)
        grouped = expected.groupby("k")[["a", "b"]]
        expected[["a", "b"]] = grouped.ffill() if forward else grouped.bfill()
        assert len(ours) == len(expected)
        assert_same(ours, expected, ["a", "b"])


@pytest.mark.parametrize("segment,fan", [(1, 2), (4, 3), (1000, 1024)])
def test_ordinal_over_groups_of_segments(spark, segment, fan):
    at = sorted({int(x) for x in np.random.default_rng(6).integers(0, 500, 90)})
    df = spark.createDataFrame([(x,) for x in at], "i long").repartition(4)
    rows = series.with_ordinal(df, series.Axis(order="i", segment=segment, fan=fan)).collect()
    assert {r.i: r.ordinal for r in rows} == {x: n for n, x in enumerate(at)}


@pytest.mark.parametrize("bucket,fan", [(1, 2), (3, 2), (7, 100), (10_000, 1024)])
def test_is_sorted_over_groups_of_buckets(spark, bucket, fan):
    def check(values, keys=()):
        rows = [(n % 2 if keys else 0, 10 * n, v) for n, v in enumerate(values)]
        df = spark.createDataFrame(rows, "k long, seq long, ts double").repartition(3)
        return validate.is_sorted(df, "ts", keys=keys, rows_per_bucket=bucket, fan=fan).first().is_sorted

    rising = [float(n // 2) for n in range(60)]
    assert check(rising) and check([])
    for at in (1, 17, 30, 59):
        assert not check([*rising[:at], -1.0, *rising[at + 1 :]])
    assert not check([*rising, None])
    # Each of two interleaved series rises, the whole does not.
    woven = [float(n + 100 * (n % 2)) for n in range(60)]
    assert check(woven, ("k",)) and not check(woven)


@pytest.mark.parametrize("dense", [True, False])
@pytest.mark.parametrize("segment", [24, 31, 1000])
def test_feature_stage_equals_its_steps(spark, segment, dense):
    rng = np.random.default_rng(12)
    rows = [(k, n if dense else 3 * n + k, *[None if rng.random() < 0.2 else float(x) for x in rng.normal(size=3)])
            for k in (0, 1) for n in range(90)]
    schema = "k long, i long, temperature double, voltage double, current double"
    df = spark.createDataFrame(rows, schema).repartition(4)
    axis = series.Axis(order="i", keys=("k",), segment=segment, dense=dense, fan=2)
    ours = as_pandas(features.engineer_features(df, axis), ["k", "i"])
    steps = as_pandas(series.bfill(features.derive_features(df, axis), axis=axis), ["k", "i"])
    assert list(ours.columns) == list(steps.columns) and len(ours) == 180
    assert_same(ours, steps, ours.columns)


def test_feature_stage_moves_its_rows_once(spark):
    frame = spark.range(2000).select(
        (F.col("id") % 3).alias("k"), (F.col("id") / 3).cast("long").alias("i"),
        *[F.col("id").cast("double").alias(c) for c in ("temperature", "voltage", "current")],
    )
    df = features.engineer_features(frame, series.Axis(order="i", keys=("k",), dense=True, segment=100))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    moved = [line for line in plan.splitlines() if " Exchange hashpartitioning" in line and "_home" in line]
    assert len({line.split("plan_id=")[1] for line in moved}) <= 2 and "ReusedExchange" in plan
    # One exchange holds rows; what else is dealt out by segment are the ends of segments.
    assert sum("SinglePartition" in line for line in plan.splitlines()) == 0


@pytest.mark.parametrize("segment", [30, 1000])
def test_feature_stage_reads_only_long_series_for_what_it_carries(spark, segment):
    """Series of one segment carry nothing: windows run once and no rows are joined."""
    frame = spark.range(120).select(
        (F.col("id") % 3).alias("k"), F.floor(F.col("id") / 3).alias("i"),
        F.when(F.col("id") >= 117, 5.0).alias("temperature"),
        *[F.lit(None).cast("double").alias(c) for c in ("voltage", "current")],
    )
    axis = series.Axis(order="i", keys=("k",), dense=True, segment=segment)
    df = features.engineer_features(frame, axis)
    assert {r.temperature for r in df.collect()} == {5.0} and df.count() == 120
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Forward windows and the fill behind them; where series are long, both sides of a join.
    assert (plan.count("Join") == 0 and plan.count("Window") == 2) == (segment == 1000)
