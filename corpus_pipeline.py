"""Corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the
next one's ``docs``. The first four return the columns of documents; the last returns pieces of
sequences. The models of the first two stages are learned from ``labels`` on what the stage is given.

Defined results of every stage: an empty table gives no rows, a null text counts as an empty one, rows
with a null or repeated id are judged one by one (near-duplicates keep one row of each group, the
smallest id first and null ids last), and columns beyond those of documents are handed on as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tenurelake.llm import mixing, packing, quality_model, simhash, toxicity
from tenurelake.llm.common import table
from tenurelake.session import shared_dir

MIN_QUALITY = 0.5


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores ``MIN_QUALITY`` or more."""
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality_model.quality_score(docs, model) >= MIN_QUALITY)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier scores under its threshold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.toxicity_score(docs, model) < model.threshold)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that steps of at most 3 differing fingerprint bits connect."""
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in an order that gives each source its target weight, tempered by its size."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, each with the sequence it belongs to and its place there."""
    return packing.pack(docs, keep=["doc_id", "source"])


STAGES = [
    ("quality classifier", keep_good),
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # trained models, hashing of shingles and tokenizers are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
