"""Sources, sinks and whole pipelines."""

import datetime as dt
import glob
import math

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pulsegrid.operators import generate, validate
from pulsegrid.operators.profile import ingest_profile
from pulsegrid.plans import health
from pulsegrid.schemas import HOLDOUT, METRICS, REVIEWS, TELEMETRY
from pulsegrid.session import scratch_dir
from pulsegrid.sources.tables import read_table, write_report, write_table


@pytest.fixture(scope="module")
def raw(spark):
    return generate.generate_telemetry(spark, days=4).cache()


def write_lines(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_missing_file_raises(spark, folder):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_table(spark, f"{folder}/absent")
    with pytest.raises(ValueError, match="unknown format"):
        read_table(spark, folder, fmt="xml")


def test_csv_missing_values_and_column_order(spark, folder):
    header = "voltage,timestamp,temperature,current,angular_velocity,solar_power"
    write_lines(f"{folder}/t.csv", [header, "28,2024-01-01 00:00:00,,NaN,nan,1e2", "NA,,1,2,3,4"])
    first, second = read_table(spark, f"{folder}/t.csv", TELEMETRY, "csv", file_order="seq").orderBy("seq").collect()
    assert (first.timestamp, first.voltage) == (dt.datetime(2024, 1, 1), 28.0)
    assert (first.temperature, first.current, first.angular_velocity, first.solar_power) == (None, None, None, 100.0)
    assert (second.voltage, second.timestamp, second.solar_power) == (None, None, 4.0)


def test_csv_value_of_the_wrong_type_raises(spark, folder):
    write_lines(f"{folder}/t.csv", ["timestamp,temperature", "2024-01-01,warm"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_table(spark, f"{folder}/t.csv", TELEMETRY, "csv").collect()


def test_csv_types_are_inferred_without_a_schema(spark, folder):
    write_lines(f"{folder}/t.csv", ["n,x", "1,1.5", "2,"])
    df = read_table(spark, f"{folder}/t.csv", fmt="csv")
    assert dict(df.dtypes) == {"n": "int", "x": "double"}
    assert df.filter("x is null").count() == 1


def test_csv_review_with_line_break_and_quotes(spark, folder):
    write_lines(f"{folder}/r.csv", ["review,sentiment", '"two\nlines, ""quoted""",positive'])
    row = read_table(spark, f"{folder}/r.csv", REVIEWS, "csv", multi_line=True).first()
    assert (row.review, row.sentiment) == ('two\nlines, "quoted"', "positive")


def test_empty_review_survives_parquet(spark, folder):
    holdout = spark.createDataFrame([("", 1)], HOLDOUT)
    assert read_table(spark, write_table(holdout, f"{folder}/h")).first().review == ""


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_file_order_sorts_rows_as_stored(spark, folder, fmt):
    df = spark.range(0, 5000, 1, 6).select(
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"), F.lit(0))).alias("timestamp"),
        F.col("id").cast("double").alias("temperature"),
    )
    path = write_table(df, f"{folder}/t", fmt)
    stored = read_table(spark, path, TELEMETRY if fmt == "csv" else None, fmt, file_order="seq")
    assert [r.temperature for r in stored.orderBy("seq").collect()] == [float(i) for i in range(5000)]
    assert validate.is_sorted(stored, rows_per_bucket=100).first().is_sorted is True


def test_file_order_goes_by_part_numbers(spark, folder):
    for number, value in ((99_999, 1.0), (100_000, 2.0)):
        pq.write_table(pa.table({"x": [value]}), f"{folder}/part-{number:05d}-a.parquet")
    rows = read_table(spark, folder, file_order="seq").orderBy("seq").collect()
    assert [r.x for r in rows] == [1.0, 2.0]


def test_an_integer_sequence_drops_duplicates_without_a_sort(spark, raw):
    plan = health.clean_telemetry(raw, "seq")._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_report_file(spark, folder):
    report = spark.createDataFrame([(1234567, 2.25, None, "ALERT")], "n long, rate_pct double, x double, status string")
    path = write_report(report, folder)
    text = "".join(open(p, encoding="utf-8").read() for p in glob.glob(f"{path}/part*"))
    assert text.splitlines() == ["n: 1,234,567", "rate pct: 2.25", "x: n/a", "status: ALERT"]


def test_scratch_folder_is_shared_one(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_simple_pipeline(spark, raw, folder):
    path = write_table(raw.drop("seq").orderBy("timestamp"), f"{folder}/raw", "csv")
    results = health.run_simple_health(spark, path, f"{folder}/out", "csv", TELEMETRY)
    checks = {(r.check, r.column): r.ok for r in results["checks"].collect()}
    assert checks[("sorted", "timestamp")] and checks[("range", "temperature")]
    report = results["report"].first()
    assert report.total_samples == 5760
    assert report.temp_anomalies > 0 and report.status in {"CAUTION", "ALERT"}
    assert glob.glob(f"{folder}/out/health_report_*")


def test_ml_pipeline(spark, raw, folder):
    late = raw.filter("minute(timestamp) = 5").withColumn("seq", F.col("seq") + 1_000_000)
    stored = raw.unionByName(late.withColumn("temperature", F.lit(0.0))).orderBy("seq").drop("seq")
    path = write_table(stored, f"{folder}/raw")
    results = health.run_ml_health(spark, path, f"{folder}/out")
    cleaned, scored = results["cleaned"], results["scored"]
    assert cleaned.count() == 96
    # The later copies were dropped: the hourly means are those of the first rows.
    expected = raw.groupBy(F.window("timestamp", "1 hour")["start"].alias("timestamp")).agg(F.avg("temperature").alias("e"))
    off = cleaned.join(expected, "timestamp").filter("abs(temperature - e) > 1e-9")
    assert off.count() == 0
    assert scored.filter(" or ".join(f"{c} is null" for c in (*METRICS, "anomaly_score"))).count() == 0
    report = results["report"].first()
    assert report.total_samples == 96
    assert report.predicted_anomalies == math.ceil(0.05 * 95)
    assert report.true_positives + report.false_negatives == report.actual_anomalies
    assert report.status == "ALERT"
    assert glob.glob(f"{folder}/out/ml_health_report_*")


def test_ingest_profile(spark, raw):
    row = ingest_profile(raw).first()
    assert (row.rows, row.columns, row.cells) == (5760, 8, 46080)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_file_order_is_one_integer_over_many_blocks(spark, folder, fmt):
    """Blocks of a few hundred bytes, several to a task: rows keep the order of the files."""
    df = spark.range(0, 3000, 1, 3).select(F.col("id").cast("double").alias("temperature"))
    path = write_table(df, f"{folder}/odd name #1", fmt)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key in before:
        spark.conf.set(key, "400")
    try:
        schema = TELEMETRY if fmt == "csv" else None
        stored = read_table(spark, path, schema, fmt, file_order="seq")
        assert dict(stored.dtypes)["seq"] == "bigint"
        rows = stored.orderBy("seq").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert [r.temperature for r in rows] == [float(i) for i in range(3000)]
    assert len({r.seq for r in rows}) == 3000


def test_duplicates_in_file_order_go_without_a_sort(spark, raw, folder):
    path = write_table(raw.drop("seq"), f"{folder}/t")
    stored = read_table(spark, path, file_order="seq")
    plan = health.clean_telemetry(stored, "seq")._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_two_reports_at_once_have_folders_of_their_own(spark, folder):
    report = spark.createDataFrame([(1,)], "n long")
    assert len({write_report(report, folder) for _ in range(3)}) == 3
    assert len(glob.glob(f"{folder}/health_report_*/part*")) == 3
