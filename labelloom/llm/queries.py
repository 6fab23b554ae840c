"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm.crosstoken import aligned
from labelloom.llm.decontaminate import leaked_items, questions_and_answers
from labelloom.llm.encode import decoded, encoded
from labelloom.llm.exact import exact_groups
from labelloom.llm.lm import katz_scores
from labelloom.llm.minmax import min_max_groups
from labelloom.llm.near import near_groups
from labelloom.llm.pii import personal_data
from labelloom.llm.quality import quality_sample
from labelloom.llm.repeats import without_repeats
from labelloom.llm.secrets import secrets
from labelloom.llm.toxicity import toxicity, train
from labelloom.llm.whitening import whiten
from labelloom.llm.work import read_table


def _remainder(n: int) -> Column:
    """The remainder by which rows are held out."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = train(docs, labels.where(_remainder(5) != 0))
    return toxicity(docs, model).select(
        "doc_id",
        F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return decoded(encoded(read_table(spark, sf_dir, "documents"), path), path, with_text=False)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    return quality_sample(read_table(spark, sf_dir, "documents"), labels)


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(7) == 2, F.lit(False))
    scores = katz_scores(docs, ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), *scores.columns[1:])


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(read_table(spark, sf_dir, "documents")).drop("secrets")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = questions_and_answers(read_table(spark, sf_dir, "benchmark"))
    return leaked_items(read_table(spark, sf_dir, "documents"), items)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read_table(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return aligned(read_table(spark, sf_dir, "documents"), a, b)


def op13_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return min_max_groups(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe": op2_bpe,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_pii": op4_pii,
    "op5_quality": op5_quality,
    "op6_lm": op6_lm,
    "op7_secrets": op7_secrets,
    "op8_decontaminate": op8_decontaminate,
    "op9_near_dedup": op9_near_dedup,
    "op10_repeats": op10_repeats,
    "op11_whitening": op11_whitening,
    "op12_alignment": op12_alignment,
    "op13_min_max": op13_min_max,
}

ORACLE_SQL = {
    "op3_exact_dedup": r"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
                   FROM documents),
             g AS (SELECT doc_id, norm, COUNT(*) OVER (PARTITION BY norm) AS group_size,
                          FIRST_VALUE(doc_id) OVER (PARTITION BY norm
                                                    ORDER BY n_chars DESC, doc_id) AS keep_id
                   FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM g""",
}
