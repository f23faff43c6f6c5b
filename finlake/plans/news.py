"""News headlines: clean two raw sources, combine, count per day, dense daily series.

The two sources have different layouts (a 12-column export and a 4-column
one); both become (date, symbol, title).  Dates arrive as timestamp text;
``try_to_date`` keeps the calendar date and turns malformed text into NULL
instead of failing the job (ANSI mode).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.operators.joins import keep_members
from finlake.sinks.writers import write_csv
from finlake.sources.text import read_news_csv

CLEAN_COLS = ("date", "symbol", "title")

# Layouts of the two raw news exports (all text; dates are parsed while cleaning).
SOURCE_A_SCHEMA = (
    "`Unnamed: 0` string, Date string, Article_title string, Stock_symbol string, Url string, "
    "Publisher string, Author string, Article string, Lsa_summary string, Luhn_summary string, "
    "Textrank_summary string, Lexrank_summary string")
SOURCE_B_SCHEMA = "`` string, title string, date string, stock string"
CLEAN_SCHEMA = "date date, symbol string, title string"


def _keep(df: DataFrame, tickers: Iterable[str] | DataFrame | None, since: str | None):
    cond = F.col("date").isNotNull()
    if since is not None:
        cond = cond & (F.col("date") >= F.lit(since).cast("date"))
    out = df.filter(cond)
    if tickers is not None:
        out = keep_members(out, "symbol", tickers)
    return out.select(*CLEAN_COLS)


def clean_source_a(raw: DataFrame, tickers=None, since: str | None = None) -> DataFrame:
    """Source with Date/Article_title/Stock_symbol columns."""
    df = raw.withColumn("Date", F.try_to_date(F.col("Date"))).withColumnsRenamed(
        {"Date": "date", "Stock_symbol": "symbol", "Article_title": "title"})
    return _keep(df, tickers, since)


def clean_source_b(raw: DataFrame, tickers=None, since: str | None = None) -> DataFrame:
    """Source with title/date/stock columns."""
    df = raw.withColumn("date", F.try_to_date(F.col("date"))).withColumnRenamed("stock", "symbol")
    return _keep(df, tickers, since)


def combine(a: DataFrame, b: DataFrame, ordered: bool = True) -> DataFrame:
    """Both sources, symbol ascending then newest first (``ordered=False``: no sort,
    for inputs of further aggregation)."""
    both = a.unionByName(b)
    return both.orderBy(F.col("symbol").asc(), F.col("date").desc()) if ordered else both


def daily_counts(news: DataFrame, symbols: Iterable[str] | None = None) -> DataFrame:
    """Headlines per (symbol, date)."""
    df = news if symbols is None else news.filter(F.col("symbol").isin(list(symbols)))
    return df.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("count"))


def dense_daily(counts: DataFrame, start: str | Column | None = None,
                end: str | Column | None = None, symbols: DataFrame | None = None) -> DataFrame:
    """Every calendar day in [start, end] for every symbol, 0 where nothing was counted.

    The calendar is generated per symbol with ``explode(sequence(...))``: its
    size is symbols x days, fixed by the parameters, and the counts are joined
    on (symbol, date).  ``symbols`` (one column) lists the companies to cover.
    With bounds and symbols given the counts are derived once; a missing one
    is read off the counts (first and last counted day, symbols with at least
    one headline), which derives them again.
    """
    if start is None or end is None:
        # both bounds from one scalar subquery over the counts
        bounds = counts.agg(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    lo = (F.lit(start).cast("date") if isinstance(start, str)
          else start if start is not None else bounds["lo"])
    hi = (F.lit(end).cast("date") if isinstance(end, str)
          else end if end is not None else bounds["hi"])
    names = (counts.select("symbol") if symbols is None
             else symbols.select(F.col(symbols.columns[0]).alias("symbol")))
    days = names.distinct().select("symbol", F.explode(F.sequence(lo, hi)).alias("date"))
    return days.join(counts, ["symbol", "date"], "left").select(
        "symbol", "date", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))


def extract_news(spark, path_a: str, path_b: str, tickers, out_path: str,
                 since: str = "2009-01-01") -> DataFrame:
    """Job: both raw exports -> cleaned, combined, sorted headlines written as CSV."""
    a = clean_source_a(read_news_csv(spark, path_a, SOURCE_A_SCHEMA), tickers, since)
    b = clean_source_b(read_news_csv(spark, path_b, SOURCE_B_SCHEMA), tickers, since)
    combined = combine(a, b)
    write_csv(combined, out_path)
    return read_news_csv(spark, out_path, CLEAN_SCHEMA)
