"""The dashboard's statements as Spark SQL text over the views of the stored tables.

Each statement reads ``fs_num``, ``fs_sub``, ``stock`` and ``ticker_cik_mapping``
(:func:`finlake.sources.tables.register_warehouse`), writes mixed-case columns
as double-quoted identifiers, and takes two named parameters instead of text
substitution: ``:symbol`` (one company, or NULL for all of them) and
``:quarter`` ('Q1', 'Q2', 'Q3', 'FY' or 'All').  They give the same rows as the
functions of :mod:`finlake.plans.kpi`.

Joins between facts and filings are on the filing key alone, so tables bucketed
by it are joined in place; the price of a day meets a fact by ticker and a
stretch of days, never by a range alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finlake.functions import tags

QUOTED = "spark.sql.ansi.doubleQuotedIdentifiers"
#: days before a fact's date in which a price counts
TOLERANCE = 10

DURATION = "((s.fp = 'FY' AND n.qtrs = 4) OR (s.fp <> 'FY' AND n.qtrs = 1))"
#: a difference, because as an equality it would be a join key beside the filing
CUMULATIVE = "n.qtrs - CASE s.fp {} END = 0".format(
    " ".join(f"WHEN '{fp}' THEN {n}" for fp, n in tags.CUMULATIVE_QTRS.items()))
KEYS = "symbol, cik, fy, fp, concat_ws('', fp, ' ', fy) AS quarter, ddate"
CHOSEN = "fp = CASE WHEN :quarter = 'All' THEN fp ELSE :quarter END"


def _listed(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def _facts(names, rule: str = "true") -> str:
    """Unsegmented facts of the tags, dated in their filing's month, with filing and company."""
    return f"""fact AS (
  SELECT c."Symbol" AS symbol, s.cik, s.folder, s.fy, s.fp, s.adsh, n.tag, n.ddate, n.value
  FROM fs_num n JOIN fs_sub s ON n.adsh = s.adsh JOIN ticker_cik_mapping c ON c."CIK" = s.cik
  WHERE n.tag IN ({_listed(names)}) AND n.segments IS NULL AND month(s.period) - month(n.ddate) = 0
    AND {rule} AND (:symbol IS NULL OR c."Symbol" = :symbol)
)"""


def _part(name: str, names, value: str = "value") -> str:
    return f"{name} AS (SELECT symbol, cik, folder, fy, fp, adsh, ddate, {value} AS {name} FROM fact WHERE tag IN ({_listed(names)}))"


def _joined(first: str, *others: str) -> str:
    return first + "".join(f" JOIN {x} ON {x}.adsh = {first}.adsh AND {x}.symbol = {first}.symbol" for x in others)


def _priced(source: str) -> str:
    """The latest bars of the days up to the fact's date, per company and folder."""
    day = "date_diff({}, DATE '1970-01-01')"
    width = TOLERANCE + 1
    return f"""near AS (
  SELECT f.*, explode(array(floor({day.format('ddate')} / {width}), floor({day.format('ddate')} / {width}) - 1)) AS stretch
  FROM {source} f
), bar AS (
  SELECT "Ticker" AS ticker, "Date" AS price_date, "Close" AS stock_price, floor({day.format('"Date"')} / {width}) AS stretch
  FROM stock
), priced AS (
  SELECT * FROM (
    SELECT near.*, price_date, stock_price,
           rank() OVER (PARTITION BY symbol, cik, folder ORDER BY price_date DESC) AS place
    FROM near JOIN bar ON ticker = symbol AND bar.stretch = near.stretch
    WHERE price_date <= ddate AND price_date >= ddate - INTERVAL '{TOLERANCE}' DAY
  ) WHERE place = 1
)"""


def _ratio(over: str, under: str) -> str:
    """x / y, NULL over zero, without a negative zero."""
    return f"try_divide({over}, {under}) + 0.0D"


def _growth(names, name: str) -> str:
    return f"""WITH {_facts(names, DURATION)}
SELECT now.symbol, now.cik, now.fy, now.fp, concat_ws('', now.fp, ' ', now.fy) AS quarter, now.tag, now.ddate,
       now.value AS curr_{name}, prev.value AS prev_{name},
       try_divide(now.value - prev.value, prev.value) * 100 + 0.0D AS {name}_growth_rate
FROM fact now LEFT JOIN fact prev
  ON prev.symbol = now.symbol AND prev.cik = now.cik AND prev.fp = now.fp AND prev.fy + 1 = now.fy
WHERE now.{CHOSEN.replace('THEN fp', 'THEN now.fp')}
ORDER BY symbol, ddate"""


def _cagr(names) -> str:
    return f"""WITH {_facts(names, "s.fp = 'FY' AND n.qtrs = 4")}, newest AS (
  SELECT *, max(fy) OVER (PARTITION BY symbol, cik) AS last_fy, min(fy) OVER (PARTITION BY symbol, cik) AS first_fy
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol, cik ORDER BY ddate DESC, adsh DESC, value DESC) AS k FROM fact)
  WHERE k <= 5
)
SELECT l.symbol, l.cik, l.fy AS latest_fy, e.fy AS earliest_fy, l.value AS latest_value, e.value AS earliest_value,
       round(pow(try_divide(l.value, e.value), 0.2D) - 1, 6) + 0.0D AS cagr
FROM newest l JOIN newest e ON e.symbol = l.symbol AND e.cik = l.cik
WHERE l.fy = l.last_fy AND e.fy = e.first_fy ORDER BY symbol"""


def _price_ratio(tag: str, name: str, out: str, value: str, rule: str = "true") -> str:
    return f"""WITH {_facts([tag], rule)}, {_priced('fact')}
SELECT {KEYS}, price_date, value AS {name}, stock_price, {value} AS {out} FROM priced WHERE {CHOSEN} ORDER BY symbol, ddate"""


def statements() -> dict[str, str]:
    """Name -> statement, for every panel of the dashboard."""
    t = tags
    balance = {"assets": [t.ASSETS], "current_assets": [t.ASSETS_CURRENT], "liabilities": [t.LIABILITIES],
               "current_liabilities": [t.LIABILITIES_CURRENT], "shares": [t.SHARES_OUTSTANDING]}
    part = lambda *names: ", ".join(_part(n, balance[n]) for n in names)
    head = lambda x: ", ".join(f"{x}.{c}" for c in ("symbol", "cik", "fy", "fp")) + (
        f", concat_ws('', {x}.fp, ' ', {x}.fy) AS quarter, {x}.ddate")
    chosen = lambda x: f"{x}." + CHOSEN.replace("THEN fp", f"THEN {x}.fp")
    order = "ORDER BY symbol, ddate"
    out = {
        "revenue_growth": _growth(t.REVENUE, "revenue"),
        "netincome_growth": _growth(t.NET_INCOME, "netincome"),
        "revenue_cagr": _cagr(t.REVENUE),
        "netincome_cagr": _cagr(t.NET_INCOME),
        "revenue_netincome": f"""WITH {_facts(t.REVENUE + t.NET_INCOME, DURATION)}, both AS (
  SELECT r.symbol, r.cik, r.fy, r.fp, r.ddate, r.tag AS revenue_tag, r.value AS revenue, i.tag AS netincome_tag,
         i.value AS netincome
  FROM fact r JOIN fact i ON i.adsh = r.adsh AND i.symbol = r.symbol
  WHERE r.tag IN ({_listed(t.REVENUE)}) AND i.tag IN ({_listed(t.NET_INCOME)})
)
SELECT {head('now')}, now.revenue_tag, now.revenue AS curr_revenue, prev.revenue AS prev_revenue,
       try_divide(now.revenue - prev.revenue, prev.revenue) * 100 + 0.0D AS revenue_growth_rate,
       now.netincome_tag, now.netincome AS curr_netincome, prev.netincome AS prev_netincome,
       try_divide(now.netincome - prev.netincome, prev.netincome) * 100 + 0.0D AS netincome_growth_rate
FROM both now LEFT JOIN both prev
  ON prev.symbol = now.symbol AND prev.cik = now.cik AND prev.fp = now.fp AND prev.fy + 1 = now.fy
WHERE :quarter = 'All' OR now.fp = :quarter {order}""",
        "margins": f"""WITH {_facts(t.REVENUE + t.COST_OF_REVENUE + t.OPERATING_COST + t.NET_INCOME, DURATION)},
{_part("revenue", t.REVENUE)}, {_part("cogs", t.COST_OF_REVENUE)}, {_part("netincome", t.NET_INCOME)}, opex AS (
  SELECT symbol, adsh, sum(value) AS operating_cost FROM fact WHERE tag IN ({_listed(t.OPERATING_COST)}) GROUP BY adsh, symbol
)
SELECT {head('revenue')}, revenue, cogs, operating_cost, netincome,
       {_ratio("revenue - cogs", "revenue")} AS gross_profit_margin,
       {_ratio("revenue - cogs - operating_cost", "revenue")} AS operating_profit_margin,
       {_ratio("netincome", "revenue")} AS net_profit_margin
FROM {_joined("revenue", "cogs", "opex", "netincome")} WHERE {chosen('revenue')} {order}""",
        "liquidity": f"""WITH {_facts([x for k in list(balance)[:4] for x in balance[k]])},
{part("assets", "current_assets", "liabilities", "current_liabilities")}
SELECT {head('assets')}, current_assets, assets, current_liabilities, liabilities,
       {_ratio("liabilities", "assets - liabilities")} AS debt_to_equity,
       {_ratio("current_assets", "current_liabilities")} AS current_ratio
FROM {_joined("assets", "current_assets", "liabilities", "current_liabilities")} WHERE {chosen('assets')} {order}""",
        "roe_roa": f"""WITH {_facts([t.ASSETS, t.LIABILITIES, *t.NET_INCOME],
                                    f"(n.tag IN ('{t.ASSETS}', '{t.LIABILITIES}') OR {DURATION})")},
{part("assets", "liabilities")}, {_part("netincome", t.NET_INCOME)}
SELECT {head('assets')}, assets, liabilities, netincome,
       {_ratio("netincome", "assets - liabilities")} AS return_on_equity, {_ratio("netincome", "assets")} AS return_on_assets
FROM {_joined("assets", "liabilities", "netincome")} WHERE {chosen('assets')} {order}""",
        "cash_flow": f"""WITH {_facts(t.OPERATING_CASH_FLOW + t.INVESTING_CASH_FLOW, CUMULATIVE)},
{_part("operating_cash_flow", t.OPERATING_CASH_FLOW)}, {_part("capital_expenditure", t.INVESTING_CASH_FLOW)}
SELECT {head('operating_cash_flow')}, operating_cash_flow, capital_expenditure,
       operating_cash_flow - capital_expenditure AS free_cash_flow
FROM {_joined("operating_cash_flow", "capital_expenditure")} WHERE {chosen('operating_cash_flow')} {order}""",
        "pe_ratio": _price_ratio(t.EPS_BASIC, "eps", "pe_ratio", _ratio("stock_price", "value"), DURATION),
        "market_cap": _price_ratio(t.SHARES_OUTSTANDING, "shares_outstanding", "market_cap", "value * stock_price + 0.0D"),
        "dividend_yield": _price_ratio(t.DIVIDENDS_PER_SHARE, "dividend", "dividend_yield", _ratio("value", "stock_price"),
                                       DURATION),
        "pb_ratio": f"""WITH {_facts([t.ASSETS, t.LIABILITIES, t.SHARES_OUTSTANDING])}, {part("assets", "liabilities", "shares")},
book AS (SELECT assets.*, liabilities, shares FROM {_joined("assets", "liabilities", "shares")}), {_priced('book')}
SELECT {KEYS}, price_date, assets, liabilities, shares, stock_price,
       {_ratio("assets - liabilities", "shares")} AS book_value_per_share,
       {_ratio("stock_price", "try_divide(assets - liabilities, shares)")} AS pb_ratio
FROM priced WHERE {CHOSEN} {order}""",
        "vs_index": f"""WITH bar AS (
  SELECT "Ticker" AS ticker, "Date" AS day, "Close" AS price FROM stock
), company AS (
  SELECT * FROM bar WHERE ticker <> '{t.INDEX_TICKER}' AND (:symbol IS NULL OR ticker = :symbol)
), base AS (
  SELECT c.ticker, c.price AS start FROM company c
  JOIN (SELECT ticker, min(day) AS day FROM company GROUP BY ticker) f ON f.ticker = c.ticker AND f.day = c.day
), idx AS (
  SELECT day, price, (SELECT min_by(p, day) FROM (
    SELECT day, collect_list(price) AS p FROM bar WHERE ticker = '{t.INDEX_TICKER}' GROUP BY day)) AS starts
  FROM bar WHERE ticker = '{t.INDEX_TICKER}'
), grown AS (
  SELECT day, {_ratio("price - start", "start")} AS index_growth FROM idx LATERAL VIEW explode(starts) x AS start
)
SELECT c.ticker AS symbol, c.day AS "Date", {_ratio("c.price - start", "start")} AS company_growth, index_growth
FROM company c JOIN base ON base.ticker = c.ticker JOIN grown ON grown.day = c.day
WHERE :quarter IS NOT NULL ORDER BY symbol, "Date" DESC""",
        "company_filings": """SELECT c."Symbol" AS symbol, s.* FROM fs_sub s JOIN ticker_cik_mapping c ON c."CIK" = s.cik
WHERE (:symbol IS NULL OR c."Symbol" = :symbol) AND (:quarter = 'All' OR s.fp = :quarter)
ORDER BY symbol, period, adsh""",
    }
    return out


def run(spark: SparkSession, name: str, symbol: str | None = None, quarter: str = "All") -> DataFrame:
    """A statement's rows for one company (or all) and one fiscal period (or all)."""
    return run_text(spark, statements()[name], {"symbol": symbol, "quarter": quarter})


def run_text(spark: SparkSession, text: str, args: dict | None = None) -> DataFrame:
    """Any statement over the views, with named parameters; ``"x"`` is an identifier, ``'x'`` a string."""
    before = spark.conf.get(QUOTED)
    spark.conf.set(QUOTED, "true")
    try:
        return spark.sql(text, args=args or {})
    finally:
        spark.conf.set(QUOTED, before)
