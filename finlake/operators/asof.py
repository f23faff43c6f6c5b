"""As-of join with a day tolerance: each fact meets the price bars dated up to
``tolerance`` days before its own date.

Spark has no native as-of join, and a join on ``Date BETWEEN d - 10 AND d``
without an equality key is planned as a cartesian product.  Here dates are cut
into buckets of ``tolerance + 1`` days; a fact meets the bars of its own and of
the previous bucket through an equi-join on (ticker, bucket), and the exact
range is checked on the joined rows.  Facts double, whatever the tolerance; the
bars are never duplicated, and a ticker's bars spread over as many join keys as
it has buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_candidates(
    facts: DataFrame,
    bars: DataFrame,
    fact_key: str,
    fact_date: str,
    bar_key: str = "Ticker",
    bar_date: str = "Date",
    tolerance_days: int = 10,
) -> DataFrame:
    """All (fact, bar) pairs with bar_date in [fact_date - tolerance, fact_date]."""
    width = tolerance_days + 1
    day = lambda c: F.unix_date(F.col(c))
    f = facts.withColumn("_bucket", F.explode(F.array(
        F.floor(day(fact_date) / width), F.floor(day(fact_date) / width) - 1)))
    b = (bars.withColumnRenamed(bar_key, "_bk")
         .withColumn("_bucket", F.floor(day(bar_date) / width)))
    joined = f.join(b, (f[fact_key] == b["_bk"]) & (f["_bucket"] == b["_bucket"]))
    in_range = ((joined[bar_date] <= joined[fact_date])
                & (joined[bar_date] >= F.date_sub(joined[fact_date], tolerance_days)))
    return joined.filter(in_range).drop(f["_bucket"]).drop(b["_bucket"]).drop("_bk")


def latest_per_group(df: DataFrame, group: list[str], date_col: str = "Date") -> DataFrame:
    """Rows ranked first by date (descending) within each group; ties all stay."""
    w = Window.partitionBy(*group).orderBy(F.col(date_col).desc())
    return df.withColumn("_rank", F.rank().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def asof_join(
    facts: DataFrame,
    bars: DataFrame,
    fact_key: str,
    fact_date: str,
    rank_group: list[str],
    bar_key: str = "Ticker",
    bar_date: str = "Date",
    tolerance_days: int = 10,
) -> DataFrame:
    """Facts with the latest bar within the tolerance, ranked per ``rank_group``.

    The rank is taken over all joined rows of a group (as the dashboard's
    ``RANK() OVER (PARTITION BY folder ORDER BY Date DESC) = 1``): when a
    group holds facts of different dates only the rows that met the latest
    bar remain.  Facts with no bar in the window drop out (inner join).
    """
    pairs = asof_candidates(facts, bars, fact_key, fact_date, bar_key, bar_date, tolerance_days)
    return latest_per_group(pairs, rank_group, bar_date)
