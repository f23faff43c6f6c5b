"""Headline sentiment: batched model scoring and the daily (tie-aware) mode.

The default scorer is a word-list expression that stays in the JVM, so the job
runs without model weights.  A real model (a transformers pipeline, an ONNX
session) comes as a factory: scoring then runs in ``mapInPandas`` -- Spark
splits the headlines over tasks and feeds Arrow batches of key and text; each
task builds the scorer once and calls it on fixed-size sub-batches, the way the
original notebooks called their classifier 1,000 or 100 titles at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.operators.modes import group_mode

Scorer = Callable[[list[str]], list[str]]

# The stand-in scorer's word lists.
POSITIVE_WORDS = (
    "gain", "gains", "growth", "profit", "profits", "rise", "rises", "rising", "beat",
    "beats", "strong", "surge", "surges", "record", "improve", "improved", "upgrade",
    "bullish", "outperform", "good", "best", "high", "up",
)
NEGATIVE_WORDS = (
    "loss", "losses", "fall", "falls", "drop", "drops", "decline", "declines", "weak",
    "miss", "misses", "downgrade", "bearish", "underperform", "lawsuit", "risk", "cut",
    "cuts", "bad", "worst", "low", "down",
)
TOKEN = re.compile(r"[a-z]+")


def lexicon_scorer() -> Scorer:
    """Label by which word list has more hits among the lower-cased a-z tokens."""
    pos, neg = frozenset(POSITIVE_WORDS), frozenset(NEGATIVE_WORDS)

    def score(texts: list[str]) -> list[str]:
        out = []
        for t in texts:
            toks = TOKEN.findall(t.lower()) if isinstance(t, str) else []
            p = sum(1 for w in toks if w in pos)
            n = sum(1 for w in toks if w in neg)
            out.append("positive" if p > n else "negative" if n > p else "neutral")
        return out

    return score


def lexicon_label(text: Column) -> Column:
    """The word-list scorer as an expression."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]+"), F.lit(0))

    def hits(listed: tuple[str, ...]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(list(listed))))

    pos, neg = hits(POSITIVE_WORDS), hits(NEGATIVE_WORDS)
    return F.when(pos > neg, "positive").when(neg > pos, "negative").otherwise("neutral")


def score_text(df: DataFrame, text_col: str = "title", out_col: str = "sentiment",
               scorer_factory: Callable[[], Scorer] | None = None,
               batch_size: int = 1000) -> DataFrame:
    """Append ``out_col`` with the scorer's label for every row (no row dropped)."""
    if scorer_factory is None:
        return df.withColumn(out_col, lexicon_label(F.col(text_col)))
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()
        for pdf in batches:
            texts = pdf[text_col].tolist()
            labels: list[str] = []
            for i in range(0, len(texts), batch_size):
                labels.extend(scorer(texts[i:i + batch_size]))
            yield pdf.assign(**{out_col: labels})

    return df.mapInPandas(run, schema)


def daily_sentiment(news_ws: DataFrame) -> DataFrame:
    """(Date, Ticker, Sentiment): the tie-resolved most frequent label per day and company."""
    m = group_mode(news_ws, ["date", "symbol"], "sentiment", out="Sentiment")
    return m.select(F.col("date").alias("Date"), F.col("symbol").alias("Ticker"), "Sentiment")


def score_news_file(spark, in_path: str, out_path: str,
                    scorer_factory: Callable[[], Scorer] | None = None,
                    batch_size: int = 100) -> DataFrame:
    """Job: cleaned headlines CSV -> the same rows plus ``sentiment``, written as CSV."""
    from finlake.plans.news import CLEAN_SCHEMA
    from finlake.sinks.writers import write_csv
    from finlake.sources.text import read_news_csv

    scored = score_text(read_news_csv(spark, in_path, CLEAN_SCHEMA), "title", "sentiment",
                        scorer_factory, batch_size)
    write_csv(scored, out_path)
    return read_news_csv(spark, out_path, CLEAN_SCHEMA + ", sentiment string")
