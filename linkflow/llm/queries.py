"""The ``opN_*`` queries over the driver's tables, the pipeline, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow.llm import ann, decontaminate, html_extract, jaccard, langid, line_dedup, manifest, mixing, order_minhash, ppm, quality, quarantine, token_planes
from linkflow.llm.common import id_crc, table


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), id_crc() % 5 == 0
    return langid.predict(docs, langid.fit(docs.where(~held_out).select("doc_id", "text", "lang")), held_out)


def quality_network(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Network | None:
    return quality.fit(docs, table(spark, sf_dir, "labels"), usable=id_crc() % 3 != 1)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality_network(spark, docs, sf_dir), id_crc() % 3 == 1)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(table(spark, sf_dir, "documents"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.pretrained(table(spark, sf_dir, "documents"), id_crc() % 10 == 0)


def op6_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_planes.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(table(spark, sf_dir, "documents"), shingle=3, percent=90).drop("class_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.flag(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.prove(table(spark, sf_dir, "documents"), id_crc() % 5 == 0, manifest.lowered())


def op12_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare(table(spark, sf_dir, "documents"))


def op13_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.replayed(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": corpus_pipeline.run, "op1_langid": op1_langid, "op2_quality": op2_quality, "op3_mixing": op3_mixing, "op4_ann": op4_ann,
        "op5_ppm": op5_ppm, "op6_token_planes": op6_token_planes, "op7_jaccard": op7_jaccard, "op8_line_dedup": op8_line_dedup,
        "op9_decontaminate": op9_decontaminate, "op10_html_extract": op10_html_extract,
        "op11_manifest": op11_manifest, "op12_order_minhash": op12_order_minhash, "op13_quarantine": op13_quarantine
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": mixing.ORACLE, "op11_manifest": manifest.ORACLE, "op13_quarantine": quarantine.ORACLE}
