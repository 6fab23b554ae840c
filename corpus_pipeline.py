"""The corpus pipeline: the stages a set of documents goes through, in order.

Each stage reads what the one before it kept and returns the columns of the documents it was given;
the last returns the encoded documents. Rows are told apart by ``doc_id``. A stage that removes rows
names the ones that go, so a document it knows nothing about stays: a row without ``doc_id`` stays in
every stage, and rows that repeat a ``doc_id`` go or stay together. Null texts are empty texts. Other
columns are passed on, also if an operator has one of the same name. No input: no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm.decontaminate import leaked_items, questions_and_answers
from labelloom.llm.encode import decoded, encoded
from labelloom.llm.exact import exact_groups
from labelloom.llm.near import near_groups
from labelloom.llm.quality import quality_sample
from labelloom.llm.work import read_table, stored, without


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents outside the sample by importance go."""
    judged = quality_sample(docs, read_table(spark, sf_dir, "labels"))
    return without(docs, judged.where("NOT kept"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts one stays."""
    return without(docs, exact_groups(docs).where("NOT kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest ``doc_id`` stays."""
    return without(docs, near_groups(docs).where(F.col("component_id") != F.col("doc_id")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    items = questions_and_answers(read_table(spark, sf_dir, "benchmark"))
    return without(docs, leaked_items(docs, items))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of the documents that are left."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return decoded(encoded(docs, path), path, with_text=False)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: SQL can express neither the trained sampling nor the encoding; tests hold each stage to its
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
