"""The registered queries of the operators: each over its whole table, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from finlake.llm import (
    decontaminate,
    exact_dedup,
    langid,
    line_dedup,
    merkle,
    mixing,
    pii,
    quality,
    simhash,
    suffix_dedup,
    toxicity,
    trie,
    urls,
)
from finlake.llm.store import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op6_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, radius=4)


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op9_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "row.text", "n_lines", "n_removed")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).drop("removed")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_nodes(table(spark, sf_dir, "conversations"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.digest_rows(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (op1_decontaminate, op2_url_filter, op3_toxicity, op4_mix_sources, op5_pii, op6_quality_cascade,
            op7_simhash, op8_language_mixture, op9_line_windows, op10_suffix_dedup, op11_conversation_trie,
            op12_exact_dedup, op13_merkle_manifest)
    return {f.__name__: f for f in made}
