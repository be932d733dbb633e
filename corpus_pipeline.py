"""The training-data pipeline: documents, stage by stage, into packed token sequences.

Each stage works on all that the one before it kept, written as Parquet and read again.
All but the last return the columns of `documents`, whatever further columns there are. A
NULL text counts as empty, NULL ids stay, and no rows give none; each stage says what else it
makes of NULLs, ties and repeated rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecall.llm import decontam, packing, quality, secrets, simhash
from rolecall.llm.common import free, table, written

THRESHOLD = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on these documents, does not reject. Each row is
    judged by its text alone, so rows that repeat all stay or all go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    score = free(docs, "_score")
    return quality.score(docs, model, score).filter(F.col(score) >= THRESHOLD).drop(score)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest doc_id, a NULL one
    counting as the largest. Texts without words are one group; repeated rows are near duplicates."""
    return simhash.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Rows that share a doc_id stay or go together."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind and n_chars kept right."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their token ids, in sequences of 1024. Repeated rows are
    packed each; an empty text is its end mark alone."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

# Not SQL: a trained network, BK-trees, random walks and a tokenizer. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
