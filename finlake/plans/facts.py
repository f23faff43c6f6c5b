"""Tidy filing facts: the shared first step of every dashboard query.

``fs_num JOIN fs_sub ON adsh`` restricted to chosen tags, no segment, a fact
date in the same month as the filing period, and a duration rule.  The
original queries run for one ticker; here every company is computed at once
and rows carry ``symbol``/``cik`` so per-company keys go into every later join
and window.  Filtering on a list of symbols gives the single-company result.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.scalar import in_millions, no_negative_zero, period_aligned, year_text

SUB_COLS = ("adsh", "folder", "form", "period", "fy", "fp", "cik")
NUM_COLS = ("adsh", "tag", "ddate", "qtrs", "uom", "segments", "value")
FACT_COLS = ("symbol", "cik", "folder", "form", "period", "fy", "fp", "adsh", "tag",
             "ddate", "qtrs", "uom", "segments", "value")


def companies(mapping: DataFrame, symbols: Iterable[str] | None = None) -> DataFrame:
    """(symbol, cik) pairs, optionally limited to some symbols."""
    out = mapping.select(F.col("Symbol").alias("symbol"), F.col("CIK").cast("bigint").alias("cik"))
    if symbols is not None:
        out = out.filter(F.col("symbol").isin(list(symbols)))
    return out


def filing_facts(
    fs_num: DataFrame,
    fs_sub: DataFrame,
    mapping: DataFrame,
    tag_list: Iterable[str],
    rule: Column | None = None,
    symbols: Iterable[str] | None = None,
) -> DataFrame:
    """Facts of the given tags joined to their filing and company.

    The tag list and ``segments IS NULL`` reach the Parquet scan as pushed
    filters; the (small) company table is joined on cik, so a symbol list
    prunes filings before the fact join.
    """
    num = fs_num.select(*NUM_COLS).filter(
        F.col("tag").isin(list(tag_list)) & F.col("segments").isNull())
    sub = fs_sub.select(*SUB_COLS).join(companies(mapping, symbols), "cik")
    facts = num.join(sub, "adsh").filter(period_aligned())
    if rule is not None:
        facts = facts.filter(rule)
    return facts.select(*FACT_COLS)


def yearly_in_millions(fs_num: DataFrame, tag_list: Iterable[str]) -> DataFrame:
    """Unsegmented facts of the tags with the year as text and the value in millions."""
    kept = fs_num.filter(F.col("tag").isin(list(tag_list)) & F.col("segments").isNull())
    return kept.select("adsh", "tag", "qtrs", year_text("ddate").alias("year"),
                       no_negative_zero(in_millions("value")).alias("millions"))


def per_filing(facts: DataFrame, lists: dict[str, tuple[Iterable[str], list[str]]],
               sums: dict[str, Iterable[str]] | None = None) -> DataFrame:
    """EAV facts -> one row per combination of tag-group facts within a filing.

    Equivalent to the dashboard's chain of inner self-joins on adsh (one
    slice per tag group, duplicates multiply, a missing group drops the
    filing), but computed in a single grouped pass: one scan of the facts and
    one shuffle on the filing key instead of one scan and shuffle per slice.
    Groups are filings, so their size is bounded by the tags a filing reports.

    ``lists``: name -> (tags, columns kept from those facts); each becomes an
    exploded struct column ``name``.  ``sums``: name -> tags summed per filing
    (present only if at least one such fact exists, like a joined GROUP BY).
    """
    tag = F.col("tag")
    aggs = []
    for name, (tag_list, cols) in lists.items():
        st = F.struct(*[F.col(c) for c in cols])
        aggs.append(F.collect_list(F.when(tag.isin(list(tag_list)), st)).alias(name))
    for name, tag_list in (sums or {}).items():
        hit = tag.isin(list(tag_list))
        aggs.append(F.sum(F.when(hit, F.col("value"))).alias(name))
        aggs.append(F.count_if(hit).alias(f"_{name}_n"))
    grouped = facts.groupBy("symbol", "cik", "adsh").agg(*aggs)
    for name in sums or {}:
        grouped = grouped.filter(F.col(f"_{name}_n") > 0).drop(f"_{name}_n")
    for name in lists:
        grouped = grouped.withColumn(name, F.explode(name))
    return grouped
