"""The corpus pipeline: quality rules, toxicity, near duplicates, personal data, best-fit packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All stages but the last return the columns of documents.
An empty or null text fails the first stage's rules. Later stages keep null ids, ties and repeated rows as their
operators' docstrings say. Texts of any length are worked on whole. Columns beside id and text go through unchanged up
to the last stage, whatever their names, but for n_chars, which follows the text. An empty table stays empty.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import near_duplicates, packing, pii, quality, queries, toxicity
from quern.llm.common import shared_dir, table

WORD_TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule of the current policy go."""
    return quality.filter_documents(docs)


def toxic_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from labels of documents that are still there."""
    return toxicity.filter_documents(docs, queries.toxicity_model(spark, sf_dir, docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, a similarity of 0.8 or more."""
    return near_duplicates.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind; n_chars follows."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences and offsets."""
    return packing.pack_documents(docs, public_tokenizers.path(WORD_TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_texts),
    ("near_duplicates", near_copies),
    ("personal_data", personal_data),
    ("best_fit_packing", packed_sequences),
]

#: Training, components and packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents. What a stage returns is written to the shared folder before the next begins."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/quern-{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
