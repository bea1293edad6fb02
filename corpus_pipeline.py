"""The corpus pipeline: documents in, token ids out. Each stage reads what the one before it wrote.

quality rules -> near-duplicates -> personal data -> mixing to target weights -> byte-level BPE
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from grainline.llm import bagminhash, bpe, mixing, quality, sanitise
from grainline.llm.store import documents, written

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the isolation forest keep."""
    docs = docs.select(*DOCUMENT)
    forest = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, forest).where("kept").select(*DOCUMENT)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    return bagminhash.keep_first(docs.select(*DOCUMENT))


def stage_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data; n_chars counts what is left."""
    return sanitise.sanitise(docs.select(*DOCUMENT))


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus at target weights: a document appears once for each pass that takes it."""
    docs = docs.select(*DOCUMENT)
    return mixing.materialise(mixing.mix(docs), DOCUMENT)


def stage_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes that they decode to."""
    docs = docs.select("doc_id", "text", "lang", "source")
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", stage_quality),
    ("near duplicates", stage_near_duplicates),
    ("personal data", stage_personal_data),
    ("mixing sources to target weights", stage_mixing),
    ("byte-level BPE", stage_tokens),
]

#: The isolation forest, signatures and tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage but the last is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
