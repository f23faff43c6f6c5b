"""Forecast features: bars + daily sentiment -> codes -> split -> scaling -> windows.

Mirrors the preparation of the original LSTM notebook for every company at
once: the per-company dictionaries of pandas frames become a ``Ticker``
column, and the loops become grouped Spark operations.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.operators.joins import keep_members
from finlake.operators.ordinals import global_positions
from finlake.operators.scaling import minmax_fit, minmax_transform
from finlake.operators.series import chronological_split, sequence_windows, window_moments
from finlake.session import cut_lineage

PRICE_COLS = ["Close", "High", "Low", "Open"]
KEY = ["Ticker"]
#: two bars of one day stand in this order
TIES = ["Date", "Close", "Open", "High", "Low"]


def price_sentiment(stock: DataFrame, daily_sentiment: DataFrame,
                    companies: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """Bars left-joined with the day's sentiment; no sentiment means 'neutral'."""
    bars = stock.select("Date", "Ticker", *PRICE_COLS)
    if companies is not None:
        bars = keep_members(bars, "Ticker", companies)
    j = bars.join(daily_sentiment, ["Date", "Ticker"], "left")
    return j.withColumn("Sentiment", F.coalesce(F.col("Sentiment"), F.lit("neutral")))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), col)


def category_codes(categories: DataFrame, col: str, code: str) -> DataFrame:
    """(category, code): position among the sorted distinct values, NULL last."""
    distinct = global_positions(categories.select(col).distinct(), col, code)
    return distinct.withColumn(code, F.col(code).cast("double"))


def ordinal_encode(df: DataFrame, cols: list[str], suffix: str = "_code",
                   sources: dict[str, DataFrame] | None = None) -> DataFrame:
    """Code each category by its position in the sorted distinct values (0.0, 1.0, ...).

    ``sources`` may name a smaller table per column that holds all of its
    values; otherwise the distinct values of ``df`` itself are used.  Codes come
    by a join, so nothing is collected.
    """
    out = df
    for c in cols:
        codes = category_codes((sources or {}).get(c, df), c, c + suffix).withColumnRenamed(c, "_cat")
        out = out.join(codes, out[c].eqNullSafe(codes["_cat"]), "left").drop("_cat")
    return out


def split_and_scale(df: DataFrame, train_fraction: float = 0.8,
                    cols: list[str] = PRICE_COLS) -> DataFrame:
    """Chronological split per company; price columns scaled with the train range."""
    split = chronological_split(df, KEY, "Date", train_fraction, TIES)
    params = minmax_fit(split.filter(F.col("split") == "train"), KEY, cols)
    return minmax_transform(split, params, KEY, cols)


def windows(scaled: DataFrame, seq_len: int = 50,
            features: list[str] | None = None) -> DataFrame:
    """Sliding windows of ``seq_len`` rows and the next close, inside each split."""
    feats = features or [*PRICE_COLS, "Ticker_code", "Sentiment_code"]
    return sequence_windows(scaled, ["Ticker", "split"], "split_rn", feats, "Close", seq_len,
                            carry=["Date"])


def prepared(stock: DataFrame, daily_sentiment: DataFrame, companies=None,
             train_fraction: float = 0.8, with_params: bool = False):
    """Encoded, split and scaled rows ready for windowing (and the scaler table)."""
    ps = price_sentiment(stock, daily_sentiment, companies)
    # The split feeds both the scaler fit and the transform; write it once to
    # the shared checkpoint folder instead of numbering the rows twice.  The
    # codes need the distinct categories only, which the written rows have.
    split = cut_lineage(chronological_split(ps, KEY, "Date", train_fraction, TIES))
    params = minmax_fit(split.filter(F.col("split") == "train"), KEY, PRICE_COLS)
    scaled = ordinal_encode(minmax_transform(split, params, KEY, PRICE_COLS), ["Ticker", "Sentiment"],
                            sources={"Ticker": split, "Sentiment": split})
    return (scaled, params) if with_params else scaled


def window_summary(scaled: DataFrame, seq_len: int = 50) -> DataFrame:
    """Length, ends, sum and position-weighted sum of each window's closes, and its target; no window is copied out."""
    win = window_moments(scaled, ["Ticker", "split"], "split_rn", "Close", seq_len, carry=["Date"])
    return win.select(
        "Ticker", "split", F.col("Date").alias("start_date"), F.lit(seq_len).alias("window_len"),
        F.round("first", 9).alias("first_close"), F.round("last", 9).alias("last_close"),
        F.round("total", 5).alias("close_sum"), F.round("by_place", 4).alias("position_sum"),
        F.round("target", 9).alias("target"))


def save_training_data(windows_df: DataFrame, params: DataFrame, root: str) -> None:
    """Persist the model inputs: windows by split, and the per-company scaler table."""
    windows_df.write.mode("overwrite").partitionBy("split").parquet(f"{root}/windows")
    params.write.mode("overwrite").parquet(f"{root}/scalers")
