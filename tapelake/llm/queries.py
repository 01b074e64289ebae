"""Registered queries of this subpackage: each operator over the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.llm import (
    decontaminate, descent, licenses, mixing, neighbours, runs, secrets, simhash, toxicity, trie, urls, webtext,
    wordpiece,
)
from tapelake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, folder, "documents"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(table(spark, folder, "documents"))


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Documents have no paths; source and language stand for directories."""
    docs = table(spark, folder, "documents")
    return licenses.licenses(docs.select("doc_id", F.concat_ws("/", "source", "lang", "doc_id").alias("path"), "text"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return webtext.main_text(table(spark, folder, "pages"))


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.periodic_runs(table(spark, folder, "documents"), runs.repeated, texts=False)


def op12_vector_copies(spark: SparkSession, folder: str) -> DataFrame:
    return descent.near_copies(table(spark, folder, "embeddings"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.opened_trie(table(spark, folder, "conversations"))


def llm_queries() -> dict[str, Query]:
    found = (
        op1_simhash, op2_token_counts, op3_decontamination, op4_neighbours, op5_mixing, op6_secrets, op7_licenses, op8_toxicity,
        op9_main_text, op10_url_filter, op11_periodic_runs, op12_vector_copies,
        op13_prefix_trie,
    )
    return {query.__name__: query for query in found}


def llm_sql() -> dict[str, str]:
    """SQL where it can express the operator."""
    return {"op5_mixing": mixing.SQL, "op13_prefix_trie": trie.SQL}
