"""A training corpus from raw documents: five stages, each written and read again.

quality (co-trained classifier) and toxicity (compression distance) let documents go that
they reject; near duplicates keep one document of each group; mixing puts the rest into the
order of the target weights; packing gives the pieces of the training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import mixing, packing, quality
from pulsegrid.llm.common import in_file_order, named, stored, table
from pulsegrid.llm.neardup import near_duplicates
from pulsegrid.llm.queries import MIX
from pulsegrid.llm.toxicity import fit_toxicity, toxicity

#: A document goes if its score is on the wrong side of this.
LEAST_QUALITY = 0.5
MOST_TOXICITY = 0.5


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.quality(model, docs)["score"] >= LEAST_QUALITY)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity(model, named("text")) < MOST_TOXICITY)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id; of repeated rows, all.

    Rows that repeat an id go or stay by their own texts. Links take a similarity of 0.8.
    """
    gone = near_duplicates(docs).filter(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_gone_text")).distinct()
    same = (named("doc_id") == F.col("_gone")) & (F.xxhash64(named("text").cast("string")) == F.col("_gone_text"))
    return docs.join(gone, same, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, MIX)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences are numbered in the order of the mix, which the files hold and a scan does not."""
    return packing.pack(in_file_order(docs))


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL has no classifiers, tokenizers or forests; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
