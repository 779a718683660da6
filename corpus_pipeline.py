"""A training corpus from documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps or changes of ``docs``
with the columns of documents; the last returns what encoding gives. Null and empty texts
and repeated rows pass through by the rules of each stage's operator, a null text as an
empty one; an empty table gives an empty result; columns beyond those of documents stay. Each result is
written as Parquet and read again as the next stage's docs. ``run`` does that in the
shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from persona_engine.llm.encode import encode_documents
from persona_engine.llm.mixing import take_mix
from persona_engine.llm.ngram_join import keep_one_of_each
from persona_engine.llm.private_terms import DisclosurePlan, sanitise_documents
from persona_engine.llm.queries import documents, labels, tokenizer_path
from persona_engine.llm.toxicity import drop_toxic, train_toxicity
from persona_engine.session import ensure_checkpoint_dir


#: Rows that travel to a Python worker at once: whole texts, some of them long.
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject (learned from the labels of four fifths of them)."""
    small_batches(spark)
    return drop_toxic(docs, train_toxicity(docs, labels(spark, sf_dir)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    small_batches(spark)
    return keep_one_of_each(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that give it away replaced or removed."""
    small_batches(spark)
    return sanitise_documents(docs, DisclosurePlan(everywhere=True))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: documents as often as they are taken, parts cut."""
    small_batches(spark)
    return take_mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    small_batches(spark)
    return encode_documents(docs, tokenizer_path())


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("private_data", private_data),
          ("mixing", mixing), ("encoding", encoding)]

#: Trees, components over hashes and the tokenizer can't be said in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written to the shared checkpoint folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
