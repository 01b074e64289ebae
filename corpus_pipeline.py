"""From documents to a training mix: toxic documents go, one of each group of near-duplicates stays, documents with
benchmark passages go, secrets are masked, and sources are mixed to their target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapelake.llm import copies, decontaminate, mixing, secrets, toxicity
from tapelake.llm.common import settle, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on labelled ones outside the held-out third, does not call toxic."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by op1's fingerprints of two bits apart at most, or by five-word Jaccard similarities of 0.8 or
    more, the document with the smallest doc_id."""
    return copies.representatives(docs, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mask."""
    return secrets.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents so that sources weigh as the square root of their size, shuffled."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
