"""A training corpus from ``documents``: five operators in a row.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns what it keeps, with the columns of documents; the last one adds the
words of the text, its copies and the number of the copy.
``run`` writes each stage's rows as Parquet in the cluster's shared folder and
reads them again for the next one; what a stage wrote on its way, and its input,
are removed then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import decontaminate, langid, line_dedup, mixing, simhash
from finlake.llm.store import is_held_out, mark, release, stored, table

#: a document of several languages stays if one of them has at least this share of its words; a clean short
#: document with a licence line or a quotation in another language is well above it
LEAST_SHARE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8.  Documents without a letter, or in which no language has a fair share of the words, go."""
    langs, model = langid.train(docs.filter(~is_held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    found = langid.identify(docs.select("text", F.struct("*").alias("row")), langs, model)
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9.  Repeated lines go; so do documents of which no line is left."""
    return line_dedup.dedup_lines(docs).filter("n_removed < n_lines or n_lines = 0").select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7.  Of each near-duplicate group the smallest id stays."""
    return simhash.representatives(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1.  Documents that contain a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4.  The training corpus: each document's whole row, once per copy; documents with none go."""
    made = ["size", "copies", "copy"]
    return mixing.emit(docs, [c for c in docs.columns if c not in made]).select("row.*", *made)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources to target weights", mix_sources),
]

#: the SVD, the fitted models and the bit counts have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, since = table(spark, sf_dir, "documents"), mark(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{k}-{name.replace(' ', '-')}")
        release(spark, since, docs)
    return docs
