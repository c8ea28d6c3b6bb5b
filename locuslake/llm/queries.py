"""The queries of the numbered operators and, where SQL can express them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from locuslake.llm import bpe, chat, clusters, mixing, neardup, negatives, pii, quality, spotsigs, tokencounts, topk, toxicity, warc
from locuslake.llm.shared import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.op1_token_counts(table(spark, sf_dir, "documents"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op3_warc(table(spark, sf_dir, "pages"))


def op4_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.op4_near_dedup(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op5_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op6_bpe(table(spark, sf_dir, "documents"))


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.op7_spotsigs(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op8_mixing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op9_pii(table(spark, sf_dir, "documents"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op10_chat(table(spark, sf_dir, "conversations"))


def op11_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.op11_kmeans(table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.op12_hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op13_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_token_counts, op2_topk, op3_warc, op4_prob_minhash, op5_toxicity, op6_bpe, op7_spotsigs, op8_mixing, op9_pii, op10_chat, op11_kmeans, op12_hard_negatives, op13_quality)}

ORACLES: dict[str, str] = {"op2_topk": topk.ORACLE, "op3_warc": warc.ORACLE, "op8_mixing": mixing.ORACLE, "op10_chat": chat.ORACLE, "op11_kmeans": clusters.ORACLE, "op12_hard_negatives": negatives.ORACLE}
