"""One thin query per operator: its whole intended table, production parameters, the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bagminhash, ball_codes, bpe, interval_search, langid, licences, line_crf, mixing, mtree, ngram_lm, quality, sanitise, toxicity
from .store import documents


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    forest = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, forest).select("doc_id", *quality.COUNTS, "base_failed", "kept", "anomaly")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ids=False)


def op3_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(documents(spark, sf_dir).select("doc_id", "text"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.find(documents(spark, sf_dir).select("doc_id", "text"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op6_mtree_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bagminhash.classes(docs).select("doc_id", "class_id", "kept", "n_shingles", "n_links")


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir).select("doc_id", "text"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = langid.fold(F.col("doc_id"), 3) == 1
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = langid.fold(F.col("doc_id"), 5) == 0
    grammar = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out))
    out = toxicity.judge(docs.select("doc_id", held_out.alias("held_out"), "text"), grammar)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_interval_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return interval_search.search(documents(spark, sf_dir).select("doc_id", "text"), items)


def op12_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_codes.report(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))


def op13_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = langid.fold(F.col("doc_id"), 5) == 0
    chain = line_crf.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out))
    out = line_crf.judge(docs.select("doc_id", held_out.alias("held_out"), "text"), chain)
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_ngram_lm": op3_ngram_lm,
    "op4_personal_data": op4_personal_data,
    "op5_mixing": op5_mixing,
    "op6_mtree_top5": op6_mtree_top5,
    "op7_bagminhash": op7_bagminhash,
    "op8_licences": op8_licences,
    "op9_language": op9_language,
    "op10_toxicity": op10_toxicity,
    "op11_interval_search": op11_interval_search,
    "op12_ball_codes": op12_ball_codes,
    "op13_line_crf": op13_line_crf,
}

ORACLE_SQL: dict[str, str] = {"op5_mixing": mixing.MIX_SQL, "op6_mtree_top5": mtree.TOP_SQL,
                              "op11_interval_search": interval_search.TOP_SQL, "op12_ball_codes": ball_codes.CODES_SQL}
