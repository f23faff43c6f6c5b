"""Column expressions used across the plans.

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from finlake.functions import tags


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """x / y with NULL for a zero divisor (ANSI mode raises on x/0)."""
    return F.try_divide(col_(num), col_(den))


def quarter_label(fp: str | Column = "fp", fy: str | Column = "fy") -> Column:
    """``fp || ' ' || fy`` where a NULL part is skipped (Postgres CONCAT)."""
    return F.concat_ws("", col_(fp), F.lit(" "), col_(fy).cast("string"))


def duration_rule(fp: str | Column = "fp", qtrs: str | Column = "qtrs") -> Column:
    """Year facts in annual filings, quarter facts in quarterly filings."""
    fp, qtrs = col_(fp), col_(qtrs)
    return ((fp == "FY") & (qtrs == 4)) | ((fp != "FY") & (qtrs == 1))


def year_rule(fp: str | Column = "fp", qtrs: str | Column = "qtrs") -> Column:
    fp, qtrs = col_(fp), col_(qtrs)
    return (fp == "FY") & (qtrs == 4)


def cumulative_qtrs(fp: str | Column = "fp") -> Column:
    """Quarters a year-to-date fact spans for a fiscal period; NULL otherwise."""
    fp = col_(fp)
    expr = None
    for period, n in tags.CUMULATIVE_QTRS.items():
        expr = (F.when(fp == period, n) if expr is None else expr.when(fp == period, n))
    return expr


def cumulative_rule(fp: str | Column = "fp", qtrs: str | Column = "qtrs") -> Column:
    # a difference, not an equality: see period_aligned
    return col_(qtrs) - cumulative_qtrs(fp) == 0


def period_aligned(period: str | Column = "period", ddate: str | Column = "ddate") -> Column:
    """The fact's date falls in the same month as the filing's period end.

    Written as a difference: as an equality it would become a join key beside
    the filing, and a join on both keys can't use tables bucketed by filing.
    """
    return F.month(col_(period)) - F.month(col_(ddate)) == 0


def quarter_filter(quarter: str | None, fp: str | Column = "fp") -> Column:
    """``fp = CASE WHEN q = 'All' THEN fp ELSE q END``: NULL fp never passes."""
    fp = col_(fp)
    if quarter is None or quarter == "All":
        return fp.isNotNull()
    return fp == F.lit(quarter)


def year_text(day: str | Column) -> Column:
    """First four characters of a date written as ``yyyyMMdd``."""
    return F.substring(F.date_format(col_(day), "yyyyMMdd"), 1, 4)


def in_millions(value: str | Column) -> Column:
    return col_(value) / F.lit(1e6)


def no_negative_zero(c: Column) -> Column:
    return c + F.lit(0.0)


def rounded(c: Column, places: int = 6) -> Column:
    """Round for presentation and cross-engine comparison; -0.0 becomes 0.0."""
    return no_negative_zero(F.round(c, places))


def pretty_size(n: str | Column) -> Column:
    """Human-readable byte count in the style of ``pg_size_pretty``.

    Bytes below 10 kB; otherwise the first unit whose value stays below
    10240, rounded half up from the value kept with one extra bit.
    """
    n = col_(n).cast("long")
    expr = F.when(F.abs(n) < 10 * 1024, F.format_string("%d bytes", n))
    for k, unit in enumerate(("kB", "MB", "GB", "TB"), start=1):
        half = F.shiftright(n, 10 * k - 1)  # value in half-units
        expr = expr.when(F.abs(half) < 20 * 1024 - 1,
                         F.format_string("%d %s", F.floor((half + 1) / 2), F.lit(unit)))
    half_pb = F.shiftright(n, 49)
    return expr.otherwise(F.format_string("%d PB", F.floor((half_pb + 1) / 2)))
