"""A review stream that is killed goes on without losing or doubling a row."""

import os

import pytest
from pyspark.sql import functions as F

from pulsegrid.plans.catalog import QUERIES
from pulsegrid.plans.sentiment import predict_reviews, train_sentiment
from pulsegrid.streaming.reviews import read_review_stream, start_predictions


@pytest.fixture(scope="module")
def model(spark):
    rows = [(k, ("good fine film" if k % 2 else "bad poor film") + f" w{k % 5}", "positive" if k % 2 else "negative")
            for k in range(40)]
    return train_sentiment(spark.createDataFrame(rows, "key long, review string, sentiment string"), "key")[0]


def forget(log, batch):
    """As if the process had died before it wrote this entry of a log."""
    for name in (f"{log}/{batch}", f"{log}/.{batch}.crc"):
        if os.path.exists(name):
            os.unlink(name)


@pytest.mark.parametrize("lost,read_again", [
    (["progress/commits"], []),  # the sink's log knows the batch: it is skipped
    (["progress/commits", "out/_spark_metadata"], [1]),  # its files are there, but count as not written
])
def test_a_killed_batch_is_written_once(spark, model, folder, lost, read_again):
    """Killed after the output was committed but not the progress, or before either was."""
    schema = "key long, review string"

    def arrive(name, first):
        rows = [(k, f"{'good' if k % 3 else 'bad'} film {k}") for k in range(first, first + 20)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")
        for part in os.listdir(f"{folder}/{name}"):
            if part.endswith(".parquet"):
                os.makedirs(f"{folder}/in", exist_ok=True)
                os.link(f"{folder}/{name}/{part}", f"{folder}/in/{name}.parquet")

    def run():
        reviews = read_review_stream(spark, f"{folder}/in", spark.createDataFrame([], schema).schema)
        query = start_predictions(reviews, model, f"{folder}/out", f"{folder}/progress")
        query.awaitTermination()
        return [p["batchId"] for p in map(dict, query.recentProgress) if p["numInputRows"]]

    arrive("a", 0)
    run()
    arrive("b", 100)
    assert run() == [1]
    for log in lost:
        assert os.path.exists(f"{folder}/{log}/1")
        forget(f"{folder}/{log}", 1)
    arrive("c", 200)
    assert run() == [*read_again, 2]
    given = spark.read.schema(schema).parquet(f"{folder}/in")
    want = sorted(map(tuple, predict_reviews(given, model).select("key", "sentiment").collect()))
    found = spark.read.parquet(f"{folder}/out")
    assert sorted(map(tuple, found.select("key", "sentiment").collect())) == want
    assert found.select(F.countDistinct("key")).first()[0] == len(want) == 60


@pytest.mark.parametrize("parts,by", [(3, []), (1, ["lang"]), (0, [])])
def test_documents_stream_from_a_folder_or_one_file(spark, folder, parts, by):
    """Part files, also below a partition column, or (no parts) a single file by the table's name."""
    rows = [(k, ("good fine film" if k % 2 else "bad poor film") + f" w{k % 5}", "de" if k % 3 else "en")
            for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = f"{folder}/documents.parquet" if parts else f"{folder}/one"
    docs.repartition(parts or 1).write.partitionBy(*by).parquet(out)
    if not parts:
        part = next(p for p in os.listdir(out) if p.endswith(".parquet"))
        os.link(f"{out}/{part}", f"{folder}/documents.parquet")
    docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality").write.parquet(f"{folder}/labels.parquet")
    found = QUERIES["sentiment_stream"](spark, folder).collect()
    assert sorted(map(tuple, found)) == [(k, True) for k in range(40)]
