"""From raw documents to token ids: toxicity, near-dedup, PII, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. run() applies them to the
documents table, each stage written as Parquet in the shared folder and read again as the next one's docs.

Defined cases, stage by stage. Toxicity: a text that is null or has no words has no evidence and stays; rows that share a
doc_id are judged by their own text. Near duplicates: texts without words stay, a repeated row stands once, a class
without any doc_id keeps one row. PII: null texts stay null with a null n_chars, every row stays. Mixing: nothing is taken of a text without
words, so such rows end here; rows equal in doc_id, source and text share what they take together; a null source
is a source. Encoding: a null text has no ids. An empty table gives empty tables; extra columns pass through, and those
named text, ids or n_tokens give way to the last stage's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslake.llm import bpe, mixing, neardup, pii, toxicity
from locuslake.llm.shared import drop_written, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5; the classifier learns from labels outside the held-out fifth."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.dedup(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by the kind in angle brackets."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, kept or left out so that each source comes to its target of words."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the text, as (doc_id, lang, source, n_chars, n_tokens, ids)."""
    return bpe.encode(docs).withColumn("n_tokens", F.size("ids").cast("long")).select(*[c for c in docs.columns if c not in ("text", "ids", "n_tokens")], "n_tokens", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: The stages are learned, sketched or iterative: no SQL states run()'s rows; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{k}_{name}")
        if before is not None:
            drop_written(before)
        before = docs
    return docs
