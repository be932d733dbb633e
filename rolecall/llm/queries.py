"""Registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecall.llm import align, chat, decontam, ngram, packing, quality, repeats, resample, rules, secrets, simhash, topk, warc
from rolecall.llm.common import table
from rolecall.sources import shared_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op2_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans as text, in code points of the whole rendering."""
    rows = chat.rotate(table(spark, sf_dir, "conversations"))
    mask = F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string")))
    return rows.select("conv_id", "speaker", "part", "text", F.array_join(mask, ",").alias("mask"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op5_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.score(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_spans(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.digest(align.link_counts(table(spark, sf_dir, "documents"), TOKENIZER, PIECES))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_ALL = (
    op1_secrets, op2_decontam, op3_chat, op4_simhash, op5_ngram, op6_quality, op7_packing, op8_rules, op9_repeats,
    op10_warc, op11_resample, op12_topk, op13_align, pipeline,
)
QUERIES = {query.__name__: query for query in _ALL}
ORACLE = {"op3_chat": chat.ORACLE, "op12_topk": topk.ORACLE}
