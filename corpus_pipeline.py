"""From documents to token ids: five stages, each written and read again before the next.

Null and empty texts have no words, so no stage rejects, groups or changes them, and they have no tokens. Rows that
repeat a doc_id are one document: they are kept or dropped together. An empty table gives an empty one. Further
columns, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lamina.llm import _common, bpe, decontam, minhash, secret_scan, toxicity


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    return toxicity.reject(docs, toxicity.train(docs, _common.table(spark, sf_dir, "labels")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is alike in five-word shingles to 0.8 or more."""
    return minhash.keep_one(docs, size=5, threshold=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten benchmark words."""
    return decontam.remove_documents(docs, _common.table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The count and digest of each document's ids, and the digest of what they decode to."""
    return bpe.digests(docs)


STAGES = [("toxicity", reject_toxic), ("near_dedup", deduplicate), ("decontamination", decontaminate), ("secrets", redact_secrets), ("byte_bpe", encode)]

#: SQL can express neither the random field nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = _common.Scratch(spark, "pipeline")
    docs = _common.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        with _common.cleaned():  # what a stage saved on its way goes once its result is there
            docs = scratch.save(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
