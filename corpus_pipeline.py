"""A corpus pipeline of five stages: each reads what its predecessor kept and wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linkflow.llm import decontaminate, jaccard, mixing, token_planes
from linkflow.llm import quality as quality_model
from linkflow.llm.common import id_crc, release, save, table

CACHE_WORDS = 150_000
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score under 0.5) go."""
    net = quality_model.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), usable=id_crc() % 3 != 1)
    return quality_model.keep(docs.select(*DOCUMENT), net)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more) stays."""
    return jaccard.keep_one(docs.select(*DOCUMENT), shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontaminate.keep_clean(docs.select(*DOCUMENT), table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources meet their target weights, and shuffled."""
    return mixing.replicate(docs.select(*DOCUMENT)).select(*DOCUMENT)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids are written to plane files and read back: their digest per document."""
    # The workers have served other stages before, so this one remembers fewer words.
    return token_planes.digests(docs, public_tokenizers.path("word_bpe_49k.json"), cache_words=CACHE_WORDS)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mix", mix), ("token_ids", token_ids)]

#: The classifier's and the tokenizer's results cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
        # What a stage has read is of no more use once its result is saved.
        if before is not None:
            release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
