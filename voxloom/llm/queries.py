"""The registered query of each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm import chat, decontamination, divergence, fim, langid, packing, pii, quality, secrets, simhash, substrings, topk, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_every(table(spark, sf_dir, "embeddings"), step=50, k=5)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.learn(docs))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_chat": op3_chat,
    "op4_simhash": op4_simhash,
    "op5_quality": op5_quality,
    "op6_topk": op6_topk,
    "op7_packing": op7_packing,
    "op8_pii": op8_pii,
    "op9_secrets": op9_secrets,
    "op10_substrings": op10_substrings,
    "op11_language": op11_language,
    "op12_fim": op12_fim,
    "op13_divergence": op13_divergence,
}
SQL: dict[str, str] = {"op3_chat": chat.SQL, "op6_topk": topk.SQL, "op10_substrings": substrings.SQL,
                      "op12_fim": fim.SQL, "op13_divergence": divergence.SQL}
