"""Company KPI queries (the dashboard), computed for every company at once.

Each function takes the filing tables (``fs_num``, ``fs_sub``), the
ticker/CIK mapping and, for price-based ratios, the daily bars.  ``symbols``
limits the companies and ``quarter`` is the dashboard's fiscal-period
selector ('All', 'Q1', 'Q2', 'Q3' or 'FY').  Outputs are sorted by company
and fact date.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake.functions import tags
from finlake.functions.scalar import (
    cumulative_rule, duration_rule, no_negative_zero, quarter_filter, quarter_label, rounded,
    safe_div, year_rule)
from finlake.operators.asof import asof_join
from finlake.plans.facts import companies, filing_facts, per_filing

KEY = ["symbol", "cik"]
PERIOD = ["fy", "fp"]

# Ratios are single IEEE operations on stored values and are returned as
# computed; rounding them would only move ties (x.5 at the last kept place,
# common when dividing by share counts) between engines.  Only values from
# pow() are rounded, to 6 places.
exact = no_negative_zero


def _growth(curr: str, prev: str) -> F.Column:
    return exact(safe_div(F.col(curr) - F.col(prev), F.col(prev)) * 100)


def _ordered(df: DataFrame, *extra: str) -> DataFrame:
    return df.orderBy(F.col("symbol").asc_nulls_last(), F.col("ddate").asc_nulls_last(), *extra)


def _year_over_year(rows: DataFrame, carried: list[str]) -> DataFrame:
    """Each row with the same fiscal period of the previous fiscal year.

    Same result as ``LEFT JOIN prev ON fp = prev.fp AND fy = prev.fy + 1``
    (duplicates multiply, a missing year or a NULL fp/fy gives NULL), but from
    one scan: a window per (company, fp) ordered by fy whose RANGE frame is
    exactly the previous year.  A partition holds one company's facts of one
    fiscal period over the years, so it stays small for any company.
    """
    w = Window.partitionBy(*KEY, "fp").orderBy("fy").rangeBetween(-1, -1)
    prev_rows = F.collect_list(F.struct(*[F.col(c).alias(f"prev_{c}") for c in carried])).over(w)
    keyed = F.col("fp").isNotNull() & F.col("fy").isNotNull()
    out = rows.withColumn("_prev", F.when(keyed, prev_rows))
    out = out.withColumn("_prev", F.explode_outer("_prev"))
    return out.select("*", *[F.col(f"_prev.prev_{c}").alias(f"prev_{c}") for c in carried]) \
        .drop("_prev")


# ----------------------------------------------------------- growth queries

def single_tag_growth(fs_num, fs_sub, mapping, tag_list, name, symbols=None, quarter="All"):
    facts = filing_facts(fs_num, fs_sub, mapping, tag_list, duration_rule(), symbols)
    rows = facts.select(*KEY, *PERIOD, "tag", "ddate", F.col("value").alias(name))
    out = _year_over_year(rows, [name]).filter(quarter_filter(quarter))
    return _ordered(out.select(
        *KEY, *PERIOD, quarter_label().alias("quarter"), "tag", "ddate",
        F.col(name).alias(f"curr_{name}"), F.col(f"prev_{name}"),
        _growth(name, f"prev_{name}").alias(f"{name}_growth_rate"),
    ))


def revenue_growth(fs_num, fs_sub, mapping, symbols=None, quarter="All") -> DataFrame:
    """Revenue, prior-year revenue and growth rate per filing period."""
    return single_tag_growth(fs_num, fs_sub, mapping, tags.REVENUE, "revenue", symbols, quarter)


def netincome_growth(fs_num, fs_sub, mapping, symbols=None, quarter="All") -> DataFrame:
    """Net income, prior-year net income and growth rate per filing period."""
    return single_tag_growth(fs_num, fs_sub, mapping, tags.NET_INCOME, "netincome",
                             symbols, quarter)


def revenue_netincome(fs_num, fs_sub, mapping, symbols=None, quarter=None) -> DataFrame:
    """Revenue and net income side by side with both year-over-year rates."""
    facts = filing_facts(fs_num, fs_sub, mapping, tags.REVENUE + tags.NET_INCOME,
                         duration_rule(), symbols)
    wide = per_filing(facts, {
        "r": (tags.REVENUE, ["fy", "fp", "ddate", "tag", "value"]),
        "i": (tags.NET_INCOME, ["tag", "value"]),
    })
    rows = wide.select(
        *KEY, "adsh", "r.fy", "r.fp", "r.ddate",
        F.col("r.tag").alias("revenue_tag"), F.col("r.value").alias("revenue"),
        F.col("i.tag").alias("netincome_tag"), F.col("i.value").alias("netincome"))
    out = _year_over_year(rows, ["revenue", "netincome"])
    if quarter is not None:
        out = out.filter(quarter_filter(quarter))
    return _ordered(out.select(
        *KEY, *PERIOD, quarter_label().alias("quarter"), "ddate",
        "revenue_tag", F.col("revenue").alias("curr_revenue"), "prev_revenue",
        _growth("revenue", "prev_revenue").alias("revenue_growth_rate"),
        "netincome_tag", F.col("netincome").alias("curr_netincome"), "prev_netincome",
        _growth("netincome", "prev_netincome").alias("netincome_growth_rate"),
    ))


def cagr(fs_num, fs_sub, mapping, tag_list, symbols=None, years: int = 5,
         exponent: float | None = 0.2) -> DataFrame:
    """Compound growth between the earliest and latest of the newest ``years`` annual facts.

    ``exponent`` is the dashboard's fixed 0.2; pass ``None`` to use
    1 / (latest fy - earliest fy) instead.  Ties in the top-N are broken by
    (ddate, adsh, value) descending; several facts sharing the latest or the
    earliest fiscal year give one row per pair, as the SQL cross join does.
    """
    facts = filing_facts(fs_num, fs_sub, mapping, tag_list, year_rule(), symbols)
    by_company = Window.partitionBy(*KEY)
    newest = by_company.orderBy(F.col("ddate").desc(), F.col("adsh").desc(), F.col("value").desc())
    top = (facts.withColumn("_rn", F.row_number().over(newest))
                .filter(F.col("_rn") <= years)
                .withColumn("_max_fy", F.max("fy").over(by_company))
                .withColumn("_min_fy", F.min("fy").over(by_company)))
    latest = top.filter(F.col("fy") == F.col("_max_fy")).select(
        *KEY, F.col("fy").alias("latest_fy"), F.col("value").alias("latest_value"))
    earliest = top.filter(F.col("fy") == F.col("_min_fy")).select(
        *KEY, F.col("fy").alias("earliest_fy"), F.col("value").alias("earliest_value"))
    pairs = latest.join(earliest, KEY)
    ratio = safe_div(F.col("latest_value"), F.col("earliest_value"))
    exp = (F.lit(exponent) if exponent is not None
           else safe_div(F.lit(1.0), (F.col("latest_fy") - F.col("earliest_fy")).cast("double")))
    return pairs.select(
        *KEY, "latest_fy", "earliest_fy", "latest_value", "earliest_value",
        rounded(F.pow(ratio, exp) - 1).alias("cagr"),
    ).orderBy("symbol")


def revenue_cagr(fs_num, fs_sub, mapping, symbols=None, **kw) -> DataFrame:
    return cagr(fs_num, fs_sub, mapping, tags.REVENUE, symbols, **kw)


def netincome_cagr(fs_num, fs_sub, mapping, symbols=None, **kw) -> DataFrame:
    return cagr(fs_num, fs_sub, mapping, tags.NET_INCOME, symbols, **kw)


# ------------------------------------------------------ per-filing ratios

HEAD = ["folder", "fy", "fp", "ddate", "value"]


def _wide(facts: DataFrame, head: tuple[str, Iterable[str]], others: dict[str, Iterable[str]],
          sums: dict[str, Iterable[str]] | None = None) -> DataFrame:
    """Per filing: the head fact's period columns, one value column per tag group."""
    name, head_tags = head
    lists = {name: (head_tags, HEAD)}
    lists.update({k: (v, ["value"]) for k, v in others.items()})
    wide = per_filing(facts, lists, sums)
    return wide.select(
        *KEY, "adsh", *[F.col(f"{name}.{c}").alias(c) for c in ("folder", "fy", "fp", "ddate")],
        F.col(f"{name}.value").alias(name),
        *[F.col(f"{k}.value").alias(k) for k in others], *(sums or {}))


def margins(fs_num, fs_sub, mapping, symbols=None, quarter="All") -> DataFrame:
    """Gross, operating and net profit margins per filing."""
    all_tags = tags.REVENUE + tags.COST_OF_REVENUE + tags.OPERATING_COST + tags.NET_INCOME
    facts = filing_facts(fs_num, fs_sub, mapping, all_tags, duration_rule(), symbols)
    rows = _wide(facts, ("revenue", tags.REVENUE),
                 {"cogs": tags.COST_OF_REVENUE, "netincome": tags.NET_INCOME},
                 sums={"operating_cost": tags.OPERATING_COST}).filter(quarter_filter(quarter))
    r, c, o, n = (F.col(x) for x in ("revenue", "cogs", "operating_cost", "netincome"))
    return _ordered(rows.select(
        *KEY, *PERIOD, quarter_label().alias("quarter"), "ddate",
        "revenue", "cogs", "operating_cost", "netincome",
        exact(safe_div(r - c, r)).alias("gross_profit_margin"),
        exact(safe_div(r - c - o, r)).alias("operating_profit_margin"),
        exact(safe_div(n, r)).alias("net_profit_margin"),
    ))


def liquidity(fs_num, fs_sub, mapping, symbols=None, quarter="All") -> DataFrame:
    """Debt-to-equity and current ratio from balance-sheet (instant) facts."""
    parts = {"a": [tags.ASSETS], "ca": [tags.ASSETS_CURRENT],
             "l": [tags.LIABILITIES], "cl": [tags.LIABILITIES_CURRENT]}
    facts = filing_facts(fs_num, fs_sub, mapping, [t for v in parts.values() for t in v],
                         None, symbols)
    rows = _wide(facts, ("assets", parts["a"]),
                 {"current_assets": parts["ca"], "liabilities": parts["l"],
                  "current_liabilities": parts["cl"]}).filter(quarter_filter(quarter))
    a, ca, liab, cl = (F.col(x) for x in
                       ("assets", "current_assets", "liabilities", "current_liabilities"))
    return _ordered(rows.select(
        *KEY, *PERIOD, quarter_label().alias("quarter"), "ddate",
        "current_assets", "assets", "current_liabilities", "liabilities",
        exact(safe_div(liab, a - liab)).alias("debt_to_equity"),
        exact(safe_div(ca, cl)).alias("current_ratio"),
    ))


def roe_roa(fs_num, fs_sub, mapping, symbols=None, quarter="All") -> DataFrame:
    """Return on equity and on assets."""
    rule = (F.col("tag").isin(tags.ASSETS, tags.LIABILITIES)
            | ((F.col("tag") == tags.NET_INCOME[0]) & duration_rule()))
    facts = filing_facts(fs_num, fs_sub, mapping,
                         [tags.ASSETS, tags.LIABILITIES, *tags.NET_INCOME], rule, symbols)
    rows = _wide(facts, ("assets", [tags.ASSETS]),
                 {"liabilities": [tags.LIABILITIES], "netincome": tags.NET_INCOME}
                 ).filter(quarter_filter(quarter))
    a, liab, n = F.col("assets"), F.col("liabilities"), F.col("netincome")
    return _ordered(rows.select(
        *KEY, *PERIOD, quarter_label().alias("quarter"), "ddate",
        "assets", "liabilities", "netincome",
        exact(safe_div(n, a - liab)).alias("return_on_equity"),
        exact(safe_div(n, a)).alias("return_on_assets"),
    ))


def cash_flow(fs_num, fs_sub, mapping, symbols=None, quarter="All") -> DataFrame:
    """Operating and investing cash flow (year to date) and their difference."""
    facts = filing_facts(fs_num, fs_sub, mapping,
                         tags.OPERATING_CASH_FLOW + tags.INVESTING_CASH_FLOW,
                         cumulative_rule(), symbols)
    rows = _wide(facts, ("operating_cash_flow", tags.OPERATING_CASH_FLOW),
                 {"capital_expenditure": tags.INVESTING_CASH_FLOW}).filter(quarter_filter(quarter))
    return _ordered(rows.select(
        *KEY, *PERIOD, quarter_label().alias("quarter"), "ddate",
        "operating_cash_flow", "capital_expenditure",
        (F.col("operating_cash_flow") - F.col("capital_expenditure")).alias("free_cash_flow"),
    ))


# ------------------------------------------------------- price-based ratios

def _with_price(rows: DataFrame, stock: DataFrame, tolerance_days: int) -> DataFrame:
    bars = stock.select("Ticker", "Date", "Close")
    return asof_join(rows, bars, fact_key="symbol", fact_date="ddate",
                     rank_group=KEY + ["folder"], tolerance_days=tolerance_days)


def _price_head(df: DataFrame, value_name: str) -> DataFrame:
    return df.select(*KEY, "folder", "adsh", *PERIOD, "ddate", F.col("value").alias(value_name))


def pe_ratio(fs_num, fs_sub, mapping, stock, symbols=None, quarter="All",
             tolerance_days: int = 10) -> DataFrame:
    """Price over basic EPS, price taken as of the fact date (up to 10 days back)."""
    eps = filing_facts(fs_num, fs_sub, mapping, [tags.EPS_BASIC], duration_rule(), symbols)
    rows = _with_price(_price_head(eps, "eps"), stock, tolerance_days).filter(quarter_filter(quarter))
    return _ordered(rows.select(
        *KEY, *PERIOD, quarter_label().alias("quarter"), "ddate",
        F.col("Date").alias("price_date"), "eps", F.col("Close").alias("stock_price"),
        exact(safe_div(F.col("Close"), F.col("eps"))).alias("pe_ratio"),
    ))


def pb_ratio(fs_num, fs_sub, mapping, stock, symbols=None, quarter="All",
             tolerance_days: int = 10) -> DataFrame:
    """Price over book value per share ((assets - liabilities) / shares)."""
    parts = {"a": [tags.ASSETS], "l": [tags.LIABILITIES], "sh": [tags.SHARES_OUTSTANDING]}
    facts = filing_facts(fs_num, fs_sub, mapping, [t for v in parts.values() for t in v],
                         None, symbols)
    book = _wide(facts, ("assets", parts["a"]),
                 {"liabilities": parts["l"], "shares": parts["sh"]})
    rows = _with_price(book, stock, tolerance_days).filter(quarter_filter(quarter))
    bvps = safe_div(F.col("assets") - F.col("liabilities"), F.col("shares"))
    return _ordered(rows.select(
        *KEY, *PERIOD, quarter_label().alias("quarter"), "ddate",
        F.col("Date").alias("price_date"), "assets", "liabilities", "shares",
        F.col("Close").alias("stock_price"),
        exact(bvps).alias("book_value_per_share"),
        exact(safe_div(F.col("Close"), bvps)).alias("pb_ratio"),
    ))


def market_cap(fs_num, fs_sub, mapping, stock, symbols=None, quarter="All",
               tolerance_days: int = 10) -> DataFrame:
    """Shares outstanding times the as-of price."""
    sh = filing_facts(fs_num, fs_sub, mapping, [tags.SHARES_OUTSTANDING], None, symbols)
    rows = _with_price(_price_head(sh, "shares_outstanding"), stock, tolerance_days) \
        .filter(quarter_filter(quarter))
    return _ordered(rows.select(
        *KEY, *PERIOD, quarter_label().alias("quarter"), "ddate",
        F.col("Date").alias("price_date"), "shares_outstanding",
        F.col("Close").alias("stock_price"),
        exact(F.col("shares_outstanding") * F.col("Close")).alias("market_cap"),
    ))


def dividend_yield(fs_num, fs_sub, mapping, stock, symbols=None, quarter="All",
                   tolerance_days: int = 10) -> DataFrame:
    """Dividend per share over the as-of price."""
    dv = filing_facts(fs_num, fs_sub, mapping, [tags.DIVIDENDS_PER_SHARE], duration_rule(),
                      symbols)
    rows = _with_price(_price_head(dv, "dividend"), stock, tolerance_days) \
        .filter(quarter_filter(quarter))
    return _ordered(rows.select(
        *KEY, *PERIOD, quarter_label().alias("quarter"), "ddate",
        F.col("Date").alias("price_date"), "dividend", F.col("Close").alias("stock_price"),
        exact(safe_div(F.col("dividend"), F.col("Close"))).alias("dividend_yield"),
    ))


def vs_index(stock: DataFrame, symbols: Iterable[str] | None = None,
             index_ticker: str = tags.INDEX_TICKER) -> DataFrame:
    """Growth of each company's close and of the index since their first date.

    Company rows are joined to index rows of the same date.  All bars of a
    ticker's first date count as its base, as in a join: several of them
    multiply the rows.  Company bases are found and joined per ticker; the
    index's are one date's few prices, an array from a scalar subquery.
    """
    bars = stock.select("Ticker", "Date", F.col("Close").alias("price"))
    comp = bars.filter(F.col("Ticker") != index_ticker)
    if symbols is not None:
        comp = comp.filter(F.col("Ticker").isin(list(symbols)))
    idx = bars.filter(F.col("Ticker") == index_ticker).select(
        "Date", F.col("price").alias("index_price"))
    first_day = comp.groupBy("Ticker").agg(F.min("Date").alias("Date"))
    base = comp.join(first_day, ["Ticker", "Date"]).select(
        "Ticker", F.col("price").alias("base_price"))
    per_day = idx.groupBy("Date").agg(F.collect_list(F.struct("index_price")).alias("prices"))
    idx_base = per_day.agg(F.min_by("prices", "Date")).scalar()
    rows = comp.join(idx, "Date").join(base, "Ticker").withColumn("idx_base", F.explode(idx_base))
    first = F.col("idx_base.index_price")
    return rows.select(
        F.col("Ticker").alias("symbol"), "Date",
        exact(safe_div(F.col("price") - F.col("base_price"), F.col("base_price")))
        .alias("company_growth"),
        exact(safe_div(F.col("index_price") - first, first)).alias("index_growth"),
    ).orderBy(F.col("symbol"), F.col("Date").desc())


def company_filings(fs_sub: DataFrame, mapping: DataFrame, symbols=None) -> DataFrame:
    """All filing rows of the companies (symbol resolved through the mapping)."""
    return fs_sub.join(companies(mapping, symbols), "cik").select(
        "symbol", *[c for c in fs_sub.columns]).orderBy("symbol", "period", "adsh")
