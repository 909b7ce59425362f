import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("id", T.StringType()),
    T.StructField("t.x", T.StringType()), T.StructField("_src", T.LongType()),
])

WORDS = [f"w{k}" for k in range(400)]
LONG = " ".join(WORDS[k * 7 % 400] + str(k % 97) for k in range(30_000))
TEXTS = [
    None, "", "   ", "one", "One  two\nthree", " ".join(WORDS[:60]), " ".join(WORDS[:60]),
    " ".join(WORDS[:60] + ["extra"]), " ".join(WORDS[100:160]), LONG, LONG + " end", "\n\n a\n", "x" * 5000,
    " ".join(WORDS[:59] + ["Other", "idiot,", "<|endoftext|>"]),
]


def rows():
    return [(k, t, "en", None if k % 5 == 0 else f"s{k % 3}", len(t or ""), "x", "y", k) for k, t in enumerate(TEXTS)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, a repeated row, and columns with clashing names."""
    more = [rows()[5], (None, "no id at all here", None, None, None, None, None, None)]
    return spark.createDataFrame(rows() + more, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
