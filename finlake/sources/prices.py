"""Daily price bars: a staged wide download (field x ticker columns) -> long rows.

A market-data download is wide: one row per date and one column per
(field, ticker).  ``wide_to_long`` unpivots it and pivots the fields back,
giving one row per (Date, Ticker); a (Date, Ticker) with no value at all is
dropped, partially empty ones keep NULLs.  Volume is a 64-bit integer (index
volumes overflow 32 bits).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("Close", "High", "Low", "Open", "Volume")
DROPPED = ("Dividends", "Stock Splits")


def wide_to_long(wide: DataFrame, id_col: str = "Date", sep: str = "|",
                 fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Columns named ``{field}{sep}{ticker}`` -> (Date, Ticker, Close, High, Low, Open, Volume)."""
    value_cols = [c for c in wide.columns if c != id_col and c.split(sep, 1)[0] in fields]
    if not value_cols:
        raise ValueError("no field columns found")
    long = wide.select(id_col, *[F.col(f"`{c}`").cast("double").alias(c) for c in value_cols]) \
        .unpivot([id_col], value_cols, "field_ticker", "value") \
        .filter(F.col("value").isNotNull())
    parts = F.split(F.col("field_ticker"), sep.replace("|", r"\|"), 2)
    long = long.select(id_col, parts[0].alias("field"), parts[1].alias("Ticker"), "value")
    out = long.groupBy(id_col, "Ticker").pivot("field", list(fields)).agg(F.first("value"))
    return out.select(
        F.col(id_col).cast("date").alias("Date"), "Ticker",
        *[F.col(f).cast("bigint" if f == "Volume" else "double").alias(f) for f in fields])


def wide_maps_to_long(wide: DataFrame, id_col: str = "Date",
                      fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Wide rows with one ``map<ticker, value>`` column per field -> long bars.

    The map layout keeps a wide download of thousands of tickers as a handful
    of columns.  All fields of a date are in one row, so each ticker's struct is
    built there and ``inline`` unpacks them: nothing is shuffled.  Where all
    fields list the same tickers in the same order (a download does) the maps
    are zipped; other rows look each ticker up.
    """
    present = [f for f in fields if f in wide.columns]
    keys = [F.map_keys(F.col(f)) for f in present]
    same = F.lit(True)
    for k in keys[1:]:
        same = same & (k == keys[0])
    whole = F.lit(True)
    for f in present:
        whole = whole & F.col(f).isNotNull()

    def typed(value, field: str):
        return value.cast("bigint" if field == "Volume" else "double").alias(field)

    absent = [F.lit(None).cast("bigint" if f == "Volume" else "double").alias(f) for f in fields if f not in present]
    zipped = F.transform(
        F.arrays_zip(keys[0].alias("k"), *[F.map_values(F.col(f)).alias(f) for f in present]),
        lambda x: F.struct(x["k"].alias("Ticker"), *[typed(x[f], f) for f in present], *absent))
    every = F.array_distinct(F.flatten(F.filter(F.array(*keys), lambda k: k.isNotNull())))
    looked_up = F.transform(every, lambda t: F.struct(
        t.alias("Ticker"), *[typed(F.try_element_at(F.col(f), t), f) for f in present], *absent))
    long = wide.select(F.col(id_col).cast("date").alias("Date"),
                       F.inline(F.when(whole & same, zipped).otherwise(looked_up)))
    return long.filter(F.coalesce(*[F.col(f).cast("double") for f in fields]).isNotNull()).select("Date", "Ticker", *fields)


def long_to_wide_maps(bars: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Daily bars -> one row per date with a ticker map per field (download layout).

    A date's maps hold one entry per listed ticker, so a row is bounded by
    the number of tickers.
    """
    return bars.groupBy("Date").agg(*[
        F.map_from_entries(F.collect_list(F.struct("Ticker", f))).alias(f) for f in fields])
