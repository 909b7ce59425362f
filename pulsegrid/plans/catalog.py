"""Every operator and pipeline as a query over a folder of tables.

Doubles are rounded to six places so that engines that add in another order agree. The
cut lies just beside the half, where no short decimal can sit on it.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.text import clean_text, strip_tags, tokens
from pulsegrid.operators import evaluate, features, generate, iforest, profile, resample
from pulsegrid.operators import sampling, series, stats, textfeatures, validate
from pulsegrid.operators.sentiment import fit_sentiment, predict, sentiment_columns
from pulsegrid.operators.termmodel import (
    document_vectors,
    learned_terms,
    predict_by_terms,
    steepest,
    term_table,
)
from pulsegrid.plans import health, sentiment
from pulsegrid.schemas import FEATURE_COLS, LABEL, METRICS, TELEMETRY, TIMESTAMP
from pulsegrid.session import scratch_dir
from pulsegrid.sources.tables import read_table, write_report, write_table
from pulsegrid.sources.views import documents, pages, reviews_view, telemetry_view
from pulsegrid.streaming.reviews import read_table_stream, start_predictions

UNITS = 1e6
#: Slopes of the mean loss below this count as none; with all coefficients 0 the steepest is about 0.4.
OPTIMAL = 1e-3
USER = ("user_id",)
BY_USER = series.Axis(keys=USER, dense=True)
LIMITS = {"temperature": (0.0, 250.0), "voltage": (0.0, 99.0)}
ALL_COLUMNS = [TIMESTAMP, *METRICS, LABEL]


def rounded(df: DataFrame) -> DataFrame:
    doubles = {f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.select(*[short(F.col(c)).alias(c) if c in doubles else c for c in df.columns])


def short(value: Column) -> Column:
    """Six places; NaN, infinities and values that have no such places stay as they are."""
    cut = F.floor(value * UNITS + 0.4999) / UNITS
    return F.when(F.abs(value) < 2**53 / UNITS, cut).otherwise(value)


# --- tables the queries share ---------------------------------------------------


def minute_telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """Readings stamped by the minute, which makes duplicate timestamps."""
    readings = telemetry_view(spark, folder)
    return readings.withColumn(TIMESTAMP, resample.bin_start(TIMESTAMP, 60))


def hourly(spark: SparkSession, folder: str, keys: tuple[str, ...] = ()) -> DataFrame:
    readings = telemetry_view(spark, folder)
    return resample.resample_mean(readings, METRICS, keys=keys, label=LABEL)


def cleaned(spark: SparkSession, folder: str, keys: tuple[str, ...] = ()) -> DataFrame:
    return health.clean_telemetry(minute_telemetry(spark, folder), keys=keys)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written and read back, as the pipelines do between stages."""
    spark = df.sparkSession
    return read_table(spark, write_table(df, scratch_dir(spark, name)))


def feature_table(spark: SparkSession, folder: str, keys: tuple[str, ...] = ()) -> DataFrame:
    clean = stored(cleaned(spark, folder, keys), "cleaned")
    return features.engineer_features(clean, series.Axis(keys=keys, dense=True))


def stored_features(spark: SparkSession, folder: str, keys: tuple[str, ...] = ()) -> DataFrame:
    return stored(feature_table(spark, folder, keys), "features")


def with_score(df: DataFrame) -> DataFrame:
    """A score any engine computes alike, to check what surrounds the model."""
    return df.withColumn("anomaly_score", -F.abs(F.col("temperature") - 50) / 50)


def predicted(df: DataFrame) -> DataFrame:
    scored = with_score(df)
    threshold = iforest.contamination_threshold(scored).scalar()
    return scored.withColumns(iforest.predict_columns("anomaly_score", threshold))


# --- queries ----------------------------------------------------------------------


def q_describe(spark, folder):
    return profile.describe(telemetry_view(spark, folder), METRICS)


def q_preview(spark, folder):
    return profile.preview(telemetry_view(spark, folder)).select("seq", *ALL_COLUMNS)


def q_exact_sample(spark, folder):
    readings = telemetry_view(spark, folder).select("seq", "user_id", "temperature")
    return sampling.exact_sample(readings, 0.05, "seq")


def q_inject_faults(spark, folder):
    readings = telemetry_view(spark, folder).select("seq", *METRICS)
    return generate.inject_faults(readings)


def q_is_sorted(spark, folder):
    readings = telemetry_view(spark, folder)
    in_order = validate.is_sorted(readings, rows_per_bucket=4096)
    shuffled = readings.withColumn("seq", F.col("seq") % 97 * 1_000_000_000 + F.col("seq"))
    out_of_order = validate.is_sorted(shuffled, rows_per_bucket=4096)
    return in_order.select(F.lit("file").alias("sequence"), "is_sorted").unionByName(
        out_of_order.select(F.lit("strided").alias("sequence"), "is_sorted")
    )


def q_validate(spark, folder):
    readings = telemetry_view(spark, folder).select("seq", *ALL_COLUMNS)
    return validate.validate(readings, limits=LIMITS)


def q_parse_ts(spark, folder):
    text = telemetry_view(spark, folder).select(
        "seq", F.date_format(TIMESTAMP, "yyyy-MM-dd HH:mm:ss").alias(TIMESTAMP)
    )
    return resample.parse_ts(text)


def q_dedupe(spark, folder, keys=()):
    readings = minute_telemetry(spark, folder).select("seq", *USER, *ALL_COLUMNS)
    return resample.dedupe_first(readings, [*keys, TIMESTAMP])


def q_resample_summary(spark, folder):
    raw = minute_telemetry(spark, folder)
    kept = resample.dedupe_first(raw.select("seq", TIMESTAMP, "temperature"), [TIMESTAMP])
    return resample.resample_summary(raw, kept, resample.resample_mean(kept, ["temperature"], span=raw))


def q_ffill(spark, folder):
    return series.ffill(hourly(spark, folder, USER), axis=BY_USER)


def q_bfill(spark, folder):
    return series.bfill(hourly(spark, folder, USER), axis=BY_USER)


def q_rolling_mean(spark, folder):
    outs = [f"{c}_rolling_mean" for c in ("temp", "voltage", "current")]
    rolled = series.rolling_mean(
        hourly(spark, folder, USER), ["temperature", "voltage", "current"], outs, 24, BY_USER
    )
    return rolled.select(*USER, TIMESTAMP, *outs)


def q_rolling_readings(spark, folder):
    """Windows over the readings themselves, whose numbers leave gaps within a user."""
    readings = telemetry_view(spark, folder).select("seq", *USER, "temperature", "current")
    axis = series.Axis("seq", USER, segment=1000)
    rolled = series.rolling_mean(readings, ["temperature", "current"], ["temp_mean", "current_mean"], 5, axis)
    return series.diff(rolled, "temperature", "temp_change", axis).drop("temperature", "current")


def q_rolling_std(spark, folder):
    rolled = series.rolling_std(
        hourly(spark, folder, USER), "temperature", "temp_rolling_std", 24, BY_USER
    )
    return rolled.select(*USER, TIMESTAMP, "temp_rolling_std")


def q_diff(spark, folder):
    outs = ["temp_change", "voltage_change"]
    changed = series.diff(hourly(spark, folder, USER), ["temperature", "voltage"], outs, BY_USER)
    return changed.select(*USER, TIMESTAMP, "temp_change", "voltage_change")


def q_power(spark, folder):
    return features.power(telemetry_view(spark, folder)).select("seq", "power")


def q_sigma_filter(spark, folder):
    return stats.sigma_filter(telemetry_view(spark, folder), "temperature").select(
        "seq", TIMESTAMP, "temperature"
    )


def q_flag_outliers(spark, folder):
    return stats.flag_outliers(telemetry_view(spark, folder)).select(
        "seq", "temperature", "voltage", "temperature_outlier", "voltage_outlier"
    )


def q_predict_flags(spark, folder):
    return predicted(telemetry_view(spark, folder)).select(
        "seq", "anomaly_score", "anomaly_prediction", "is_predicted_anomaly"
    )


def q_top_anomalies(spark, folder):
    top = iforest.top_anomalies(with_score(telemetry_view(spark, folder)), order="seq")
    return top.select("seq", TIMESTAMP, "temperature", "voltage", "anomaly_score")


def q_ml_report(spark, folder):
    return health.ml_report(predicted(stored_features(spark, folder, USER)))


def q_tree_samples(spark, folder):
    readings = telemetry_view(spark, folder).select("seq")
    return iforest.tree_samples(readings, "seq").select("tree", "seq")


def _forest(spark, folder):
    table = stored_features(spark, folder, USER)
    return table, iforest.fit_iforest(table, key=[*USER, TIMESTAMP], handle_invalid="error")


def short_features(spark, folder):
    """Features of six places: trees cut between values, so these must not differ in their last bits."""
    return stored(rounded(feature_table(spark, folder, USER)), "features")


def q_iforest_nodes(spark, folder):
    """The whole forest as rows."""
    table = short_features(spark, folder)
    model = iforest.fit_iforest(table, key=[*USER, TIMESTAMP], contamination=None)
    return spark.createDataFrame(model.nodes, iforest.NODES)


WALKED = ["temperature", "current", "angular_velocity", "solar_power"]


def q_forest_walk(spark, folder):
    """Scores of the readings by joins with a saved forest."""
    readings = telemetry_view(spark, folder).select("seq", *WALKED)
    readings = stored(rounded(readings), "readings")
    path = scratch_dir(spark, "iforest")
    iforest.fit_iforest(readings, WALKED, "seq", trees=10, psi=64, contamination=None).save(spark, path)
    return iforest.walk_forest(readings, read_table(spark, f"{path}/nodes"), WALKED, ["seq"], 64)


def q_iforest_trees(spark, folder):
    """Per tree: rows drawn, rows in its leaves, depth within the limit."""
    table = stored_features(spark, folder, USER)
    model = iforest.fit_iforest(table, key=[*USER, TIMESTAMP], contamination=None)
    nodes = spark.createDataFrame(model.nodes, iforest.NODES)
    leaf = F.col("feature") < 0
    return nodes.groupBy("tree").agg(
        F.max(F.when(F.col("node") == 0, F.col("n"))).cast("bigint").alias("rows_drawn"),
        F.sum(F.when(leaf, F.col("n"))).alias("rows_in_leaves"),
        (F.max("depth") <= 8).alias("depth_ok"),
    )


def q_iforest_flags(spark, folder):
    """Scored rows, whether scores lie in [-1, 0], rows flagged below the offset."""
    table, model = _forest(spark, folder)
    scored = iforest.score_telemetry(table, model)
    return scored.agg(
        F.count("*").alias("rows"),
        F.bool_and(F.col("anomaly_score").between(-1, 0)).alias("in_range"),
        F.count_if(F.col("is_predicted_anomaly") == 1).alias("flagged"),
    )


def q_score_telemetry(spark, folder):
    """Scores and flags as the pipeline makes them: scored once, the offset from the stored scores."""
    table = short_features(spark, folder)
    model = iforest.fit_iforest(table, key=[*USER, TIMESTAMP], contamination=None)
    scores = stored(rounded(iforest.score(table, model).select(*USER, TIMESTAMP, "anomaly_score")), "scored")
    threshold = iforest.contamination_threshold(scores).scalar()
    return scores.withColumns(iforest.predict_columns("anomaly_score", threshold)).select(
        *USER, TIMESTAMP, "anomaly_prediction", "anomaly_score", "is_predicted_anomaly"
    )


def q_iforest_reload(spark, folder):
    """Rows whose score changes when the model is saved and loaded again."""
    table, model = _forest(spark, folder)
    path = scratch_dir(spark, "iforest")
    model.save(spark, path)
    again = iforest.IForestModel.load(spark, path)
    both = iforest.score(iforest.score(table, model), again, out="again")
    return both.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("again") != F.col("anomaly_score")).alias("changed"),
    )


def q_clean_text(spark, folder):
    return textfeatures.clean_reviews(documents(spark, folder)).select("doc_id", "cleaned_review")


def q_strip_html(spark, folder):
    return pages(spark, folder).select("page_id", strip_tags(F.col("html")).alias("text"))


def q_clean_html(spark, folder):
    return pages(spark, folder).select("page_id", clean_text(F.col("html")).alias("text"))


def q_map_label(spark, folder):
    langs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    return textfeatures.map_label(langs, "lang", {"en": 1, "de": 0}, "label")


def q_exact_split(spark, folder):
    reviews = reviews_view(spark, folder).select("doc_id", "sentiment")
    train, test = sampling.exact_split(reviews, 0.2, "doc_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _clean_docs(spark, folder):
    return documents(spark, folder).select("doc_id", clean_text(F.col("review")).alias("review"))


def q_tokens(spark, folder):
    return _clean_docs(spark, folder).select(
        "doc_id", F.concat_ws(" ", tokens(F.col("review"))).alias("tokens")
    )


def q_ngrams(spark, folder):
    return _clean_docs(spark, folder).select(
        "doc_id", F.concat_ws("|", textfeatures.terms("review")).alias("terms")
    )


def q_vocabulary(spark, folder):
    return textfeatures.vocabulary(_clean_docs(spark, folder), "review")


def q_tfidf(spark, folder):
    return textfeatures.tfidf(_clean_docs(spark, folder), "review", "doc_id")


ROUNDS = 5


def q_sentiment_coefficients(spark, folder):
    """The classifier's table after five full-batch rounds."""
    out = scratch_dir(spark, "sentiment")
    return sentiment.train_term_model(reviews_view(spark, folder), "doc_id", out, ROUNDS)[0]


def q_sentiment_predict(spark, folder):
    """Predictions by a join with the table of those coefficients."""
    reviews = reviews_view(spark, folder)
    terms, _ = sentiment.train_term_model(reviews, "doc_id", scratch_dir(spark, "sentiment"), ROUNDS)
    return sentiment.predict_by_table(reviews.select("doc_id", "review"), terms, "doc_id").select(
        "doc_id", "sentiment", "confidence"
    )


def q_sentiment_scores(spark, folder):
    """All measures of that classifier on the hold-out, one row each."""
    out = scratch_dir(spark, "sentiment")
    terms, holdout = sentiment.train_term_model(reviews_view(spark, folder), "doc_id", out, ROUNDS)
    scored = predict_by_terms(holdout, terms, "review", "doc_id")
    results = sentiment.evaluations(stored(scored.select("sentiment", "prediction"), "scored"))
    cells = _cells_by_name(results["metrics"], "metrics")
    cells = cells.unionByName(_cells_by_name(results["confusion"], "confusion", "actual"))
    return cells.unionByName(_cells_by_name(results["report"], "report", "class")).filter("x is not null")


def q_sentiment_optimum(spark, folder):
    """Whether the MLlib fit is the optimum of the loss, and its table predicts what it does."""
    out = scratch_dir(spark, "sentiment")
    reviews = reviews_view(spark, folder)
    train, _ = sampling.exact_split(
        sentiment.prepare_reviews(reviews), sentiment.TEST_FRACTION, "doc_id", sentiment.SEED
    )
    train = stored(train.select("doc_id", "cleaned_review", "label"), "train")
    model = fit_sentiment(train)
    write_table(term_table(spark, model), f"{out}/terms")
    terms = read_table(spark, f"{out}/terms")
    n = train.count()
    numbered = learned_terms(train, "cleaned_review", n_documents=n).drop("idf").join(terms, "term")
    numbered = stored(numbered, "numbered")
    rows = document_vectors(train, "cleaned_review", "doc_id", numbered)
    rows = rows.join(train.select("doc_id", "label"), "doc_id")
    slope = steepest(rows, numbered.select("i", "coefficient"), 1.0 / n, n).scalar()
    ours = predict_by_terms(train, terms, "cleaned_review", "doc_id").select(
        "doc_id", F.col("probability")[1].alias("p")
    )
    theirs = predict(train, model, "cleaned_review").select("doc_id", F.col("probability")[1].alias("q"))
    return ours.join(theirs, "doc_id").select(
        "doc_id", (F.abs(F.col("p") - F.col("q")) < 1e-9).alias("same_as_pipeline"),
        (slope < OPTIMAL).alias("at_optimum"),
    )


def _cells_by_name(df: DataFrame, table: str, key: str | None = None) -> DataFrame:
    """Every number of a small result table as a row with its name."""
    row = F.col(key).cast("string") if key else F.lit("")
    cells = [
        F.struct(F.concat(F.lit(f"{table}.{c}."), row).alias("name"), F.col(c).cast("double").alias("x"))
        for c in df.columns
        if c != key
    ]
    return df.select(F.inline(F.array(*cells)))


def _evaluation(results: dict[str, DataFrame]) -> DataFrame:
    """What the split fixes of an evaluation, and whether its three tables agree.

    The scores themselves depend on the fit; they must follow from the confusion cells.
    """
    cells = _cells_by_name(results["metrics"], "metrics")
    cells = cells.unionByName(_cells_by_name(results["confusion"], "confusion", "actual"))
    cells = cells.unionByName(_cells_by_name(results["report"], "report", "class"))

    def x(name: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col("x")))

    n = {(a, p): x(f"confusion.predicted_{p}.{a}") for a in (0, 1) for p in (0, 1)}
    total = n[0, 0] + n[0, 1] + n[1, 0] + n[1, 1]
    accuracy = (n[0, 0] + n[1, 1]) / total

    def over(part: Column, whole: Column) -> Column:
        return F.when(whole == 0, 0.0).otherwise(part / whole)

    scores = []
    for a in (0, 1):
        precision, recall = over(n[a, a], n[0, a] + n[1, a]), over(n[a, a], n[a, 0] + n[a, 1])
        scores.append((precision, recall, over(2 * precision * recall, precision + recall)))
    supports = [n[a, 0] + n[a, 1] for a in (0, 1)]

    def agree(*pairs: tuple[Column, Column]) -> Column:
        return F.coalesce(F.greatest(*[F.abs(p - q) for p, q in pairs]) < 1e-9, F.lit(False))

    names = ("precision", "recall", "f1_score")
    classes = [
        (x(f"report.{m}.{c}"), s)
        for c, own in zip(evaluate.CLASS_NAMES, scores) for m, s in zip(names, own)
    ]
    macro = [(x(f"report.{m}.macro avg"), (scores[0][k] + scores[1][k]) / 2) for k, m in enumerate(names)]
    weighted = [
        (x(f"report.{m}.weighted avg"), (scores[0][k] * supports[0] + scores[1][k] * supports[1]) / total)
        for k, m in enumerate(names)
    ]
    return cells.agg(
        *[x(f"report.support.{c}").cast("bigint").alias(f"support_{c.lower()}") for c in evaluate.CLASS_NAMES],
        total.cast("bigint").alias("held_out"),
        agree((x("metrics.accuracy."), accuracy),
              *[(x(f"metrics.{m}."), s) for m, s in zip(names, scores[1])]).alias("metrics_agree"),
        agree(*classes, (x("report.f1_score.accuracy"), accuracy)).alias("classes_agree"),
        agree(*macro, *weighted).alias("averages_agree"),
        (accuracy >= 0.5).alias("better_than_chance"),
    )


def q_sentiment_evaluate(spark, folder):
    """Hold-out quality of a model that was saved and loaded again."""
    out = scratch_dir(spark, "sentiment")
    sentiment.train_sentiment(reviews_view(spark, folder), "doc_id", out)
    return _evaluation(sentiment.evaluate_model(spark, f"{out}/model", f"{out}/holdout"))


def q_sentiment_pipeline(spark, folder):
    """Train, evaluate and predict: per document, whether its prediction is a sound one."""
    results = sentiment.run_sentiment(reviews_view(spark, folder), "doc_id", scratch_dir(spark, "sentiment"))
    sure = F.col("confidence").between(0.5, 1) & F.col("sentiment").isin("positive", "negative")
    return results["predictions"].select("doc_id", sure.alias("sound"))


def q_simple_health(spark, folder):
    """The pipeline without a model from stored readings: its report and a count of its checks."""
    stored_at = write_table(telemetry_view(spark, folder).select(*ALL_COLUMNS), scratch_dir(spark, "raw"))
    results = health.run_simple_health(spark, stored_at, limits=LIMITS)
    checks = results["checks"].agg(
        F.struct(
            F.count("*").alias("checks"),
            F.count_if(~F.col("ok")).alias("checks_failed"),
            F.sum(F.when(F.col("check") == "missing_values", F.col("n"))).alias("missing"),
            F.sum(F.when(F.col("check") == "range", F.col("n"))).alias("outside"),
        )
    )
    return results["report"].withColumn("found", checks.scalar()).select("*", "found.*").drop("found")


def q_holdout_table(spark, folder):
    """The hold-out as written and read back."""
    prepared = sentiment.prepare_reviews(reviews_view(spark, folder))
    _, test = sampling.exact_split(prepared, sentiment.TEST_FRACTION, "doc_id", sentiment.SEED)
    test = test.select("doc_id", F.col("cleaned_review").alias("review"), "label")
    return stored(test, "holdout")


def q_sentiment_stream(spark, folder):
    """Stream predictions, and whether each equals the batch prediction."""
    model, _ = sentiment.train_sentiment(reviews_view(spark, folder), "doc_id")
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    arriving = read_table_stream(spark, folder, "documents.parquet", schema)
    arriving = arriving.select("doc_id", F.col("text").alias("review"))
    out = scratch_dir(spark, "stream")
    start_predictions(arriving, model, f"{out}/table", f"{out}/progress").awaitTermination()
    streamed = read_table(spark, f"{out}/table")
    batch = sentiment.predict_reviews(documents(spark, folder), model).select(
        "doc_id", F.col("sentiment").alias("expected"), F.col("confidence").alias("sure")
    )
    same = (F.col("sentiment") == F.col("expected")) & (F.abs(F.col("confidence") - F.col("sure")) < 1e-9)
    return streamed.join(batch, "doc_id").select("doc_id", same.alias("same_as_batch"))


def q_sentiment_columns(spark, folder):
    p = (F.col("doc_id") % 100) / F.lit(100.0)
    given = spark.read.parquet(f"{folder}/labels.parquet").select(
        "doc_id",
        F.when(p > 0.5, 1).otherwise(0).alias("prediction"),
        F.array(1 - p, p).alias("probability"),
    )
    return sentiment_columns(given)


def _quality(spark, folder):
    return spark.read.parquet(f"{folder}/labels.parquet").select(
        F.col("quality").alias("label"), (1 - F.col("toxic")).alias("predicted")
    )


def q_csv_round_trip(spark, folder):
    readings = telemetry_view(spark, folder).select(*ALL_COLUMNS)
    path = write_table(readings, scratch_dir(spark, "csv"), "csv")
    return read_table(spark, path, TELEMETRY, "csv")


def q_parquet_round_trip(spark, folder):
    readings = telemetry_view(spark, folder).select(*ALL_COLUMNS)
    return read_table(spark, write_table(readings, scratch_dir(spark, "parquet")), TELEMETRY)


def q_report_text(spark, folder):
    """The report of all fields as the file holds it."""
    report = stats.simple_report(telemetry_view(spark, folder))
    path = write_report(report, scratch_dir(spark, "report"))
    lines = spark.read.text(path, wholetext=True)
    return lines.select(F.rtrim(F.col("value"), F.lit("\n")).alias("report"))


def q_ml_health(spark, folder):
    """The whole pipeline from stored raw readings to the report."""
    raw = minute_telemetry(spark, folder).select("seq", *USER, *ALL_COLUMNS)
    path = write_table(raw, scratch_dir(spark, "raw"))
    out = scratch_dir(spark, "health")
    report = health.run_ml_health(spark, path, out, keys=USER, handle_invalid="error", seq="seq")["report"]
    # Which rows the forest flags depends on the fit; how many, and what they add up to, does not.
    hits, false = F.col("true_positives"), F.col("false_positives")
    missed = F.col("false_negatives")
    return report.withColumns({
        "flags_add_up": hits + false == F.col("predicted_anomalies"),
        "labels_add_up": hits + missed == F.col("actual_anomalies"),
        "precision_agrees": F.abs(F.col("precision") * (hits + false) - hits) < 1e-6,
        "recall_agrees": F.abs(F.col("recall") * (hits + missed) - hits) < 1e-6,
    }).drop("true_positives", "false_positives", "false_negatives", "precision", "recall")


def _over_telemetry(operator, spark, folder):
    return operator(telemetry_view(spark, folder))


def _over_predicted(operator, spark, folder):
    return operator(predicted(telemetry_view(spark, folder)))


def _over_quality(operator, spark, folder):
    return operator(_quality(spark, folder), "label", "predicted")


def _plan() -> dict:
    def telemetry(operator):
        return partial(_over_telemetry, operator)

    return {
        "ingest_profile": telemetry(lambda df: profile.ingest_profile(df.select(*ALL_COLUMNS))),
        "label_breakdown": telemetry(generate.label_breakdown),
        "describe": q_describe,
        "preview": q_preview,
        "exact_sample": q_exact_sample,
        "inject_faults": q_inject_faults,
        "null_counts": telemetry(lambda df: validate.null_counts(df, ALL_COLUMNS)),
        "range_check": telemetry(lambda df: validate.range_check(df, LIMITS)),
        "is_sorted": q_is_sorted,
        "validate": q_validate,
        "parse_ts": q_parse_ts,
        "dedupe_first": q_dedupe,
        "dedupe_first_by_user": partial(q_dedupe, keys=USER),
        "resample_hourly": hourly,
        "resample_hourly_by_user": partial(hourly, keys=USER),
        "resample_summary": q_resample_summary,
        "ffill": q_ffill,
        "bfill": q_bfill,
        "clean_telemetry": cleaned,
        "clean_telemetry_by_user": partial(cleaned, keys=USER),
        "rolling_mean": q_rolling_mean,
        "rolling_std": q_rolling_std,
        "rolling_readings": q_rolling_readings,
        "diff": q_diff,
        "power": q_power,
        "engineer_features": feature_table,
        "engineer_features_by_user": partial(feature_table, keys=USER),
        "model_features": lambda s, d: feature_table(s, d).select(TIMESTAMP, *FEATURE_COLS),
        "system_averages": telemetry(stats.system_averages),
        "sigma_outliers": telemetry(stats.sigma_outliers),
        "sigma_filter": q_sigma_filter,
        "flag_outliers": q_flag_outliers,
        "overall_rate": telemetry(stats.overall_rate),
        "simple_report": telemetry(stats.simple_report),
        "simple_health": q_simple_health,
        "contamination_threshold": telemetry(
            lambda df: iforest.contamination_threshold(with_score(df))
        ),
        "predict_flags": q_predict_flags,
        "prediction_counts": partial(_over_predicted, stats.prediction_counts),
        "top_anomalies": q_top_anomalies,
        "detection_metrics": partial(_over_predicted, evaluate.detection_metrics),
        "ml_report": q_ml_report,
        "tree_samples": q_tree_samples,
        "iforest_trees": q_iforest_trees,
        "iforest_nodes": q_iforest_nodes,
        "forest_walk": q_forest_walk,
        "iforest_flags": q_iforest_flags,
        "iforest_reload": q_iforest_reload,
        "score_telemetry": q_score_telemetry,
        "clean_text": q_clean_text,
        "strip_html": q_strip_html,
        "clean_html": q_clean_html,
        "map_label": q_map_label,
        "exact_split": q_exact_split,
        "tokens": q_tokens,
        "ngrams": q_ngrams,
        "vocabulary": q_vocabulary,
        "tfidf": q_tfidf,
        "holdout_table": q_holdout_table,
        "sentiment_coefficients": q_sentiment_coefficients,
        "sentiment_predict": q_sentiment_predict,
        "sentiment_scores": q_sentiment_scores,
        "sentiment_optimum": q_sentiment_optimum,
        "sentiment_evaluate": q_sentiment_evaluate,
        "sentiment_pipeline": q_sentiment_pipeline,
        "sentiment_stream": q_sentiment_stream,
        "sentiment_columns": q_sentiment_columns,
        "binary_metrics": partial(_over_quality, evaluate.binary_metrics),
        "confusion_matrix": partial(_over_quality, evaluate.confusion_matrix),
        "classification_report": partial(_over_quality, evaluate.classification_report),
        "csv_round_trip": q_csv_round_trip,
        "parquet_round_trip": q_parquet_round_trip,
        "report_text": q_report_text,
        "ml_health": q_ml_health,
    }


def _rounded(query, spark, folder):
    return rounded(query(spark, folder))


QUERIES = {name: partial(_rounded, query) for name, query in _plan().items()}
