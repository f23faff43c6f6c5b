"""Dashboard KPIs on hand-made filings: the filters, joins and ratio edge cases."""

import datetime as dt
import math

import pytest

from finlake.functions import tags
from finlake.plans import kpi

from .conftest import rows

D = dt.date

SUB = [
    # folder, adsh, cik, form, period, fy, fp
    ("2020q1", "a-2020-q1", 1, "10-Q", D(2020, 3, 31), 2020, "Q1"),
    ("2020q4", "a-2020-fy", 1, "10-K", D(2020, 12, 31), 2020, "FY"),
    ("2021q1", "a-2021-q1", 1, "10-Q", D(2021, 3, 31), 2021, "Q1"),
    ("2021q1", "a-2021-q1x", 1, "10-Q", D(2021, 3, 31), 2021, "Q1"),
    ("2021q2", "a-nullfp", 1, "10-Q", D(2021, 6, 30), 2021, None),
    ("2021q4", "a-2021-fy", 1, "10-K", D(2021, 12, 31), 2021, "FY"),
    ("2019q4", "b-2019-fy", 2, "10-K", D(2019, 12, 31), 2019, "FY"),
    ("2020q3", "b-2020-q3", 2, "10-Q", D(2020, 9, 30), 2020, "Q3"),
    ("2021q3", "b-2021-q3", 2, "10-Q", D(2021, 9, 30), 2021, "Q3"),
    ("2021q3", "b-nullfy", 2, "10-Q", D(2021, 9, 30), None, "Q3"),
    ("2021q4", "b-2021-fy", 2, "10-K", D(2021, 12, 31), 2021, "FY"),
]
R = "Revenues"
NUM = [
    # adsh, tag, ddate, qtrs, uom, segments, value
    ("a-2020-q1", R, D(2020, 3, 31), 1, "USD", None, 20.0),
    ("a-2020-q1", R, D(2020, 2, 29), 1, "USD", None, 77.0),          # month mismatch
    ("a-2020-fy", R, D(2020, 12, 31), 4, "USD", None, 100.0),
    ("a-2021-fy", R, D(2021, 12, 31), 4, "USD", None, 121.0),
    ("a-2021-fy", R, D(2021, 12, 31), 1, "USD", None, 30.0),          # qtrs=1 in FY
    ("a-2021-q1", R, D(2021, 3, 31), 1, "USD", None, 25.0),
    ("a-2021-q1", "SalesRevenueNet", D(2021, 3, 31), 1, "USD", None, 26.0),  # 2nd tag
    ("a-2021-q1", R, D(2021, 3, 31), 1, "USD", "Seg", 99.0),          # segment row
    ("a-nullfp", R, D(2021, 6, 30), 1, "USD", None, 40.0),            # NULL fp
    ("b-2019-fy", R, D(2019, 12, 31), 4, "USD", None, -50.0),
    ("b-2021-fy", R, D(2021, 12, 31), 4, "USD", None, 100.0),
    ("b-2020-q3", R, D(2020, 9, 30), 1, "USD", None, 0.0),
    ("b-2021-q3", R, D(2021, 9, 30), 1, "USD", None, 10.0),
    ("b-nullfy", R, D(2021, 9, 30), 1, "USD", None, 50.0),
    ("a-2020-q1", "EarningsPerShareBasic", D(2020, 3, 31), 1, "USD", None, 2.0),
    ("a-2020-fy", "EarningsPerShareBasic", D(2020, 12, 31), 4, "USD", None, 5.0),
    ("a-2021-q1", "EarningsPerShareBasic", D(2021, 3, 31), 1, "USD", None, 0.0),
    ("a-2021-q1x", "EarningsPerShareBasic", D(2021, 3, 25), 1, "USD", None, 1.0),
]
STOCK = [
    (D(2020, 3, 20), "AAA", 39.0), (D(2020, 3, 21), "AAA", 40.0), (D(2020, 12, 20), "AAA", 60.0),
    (D(2021, 3, 24), "AAA", 45.0), (D(2021, 3, 31), "AAA", 50.0),
]


@pytest.fixture(scope="module")
def tables(spark):
    sub = spark.createDataFrame(
        SUB, "folder string, adsh string, cik bigint, form string, period date, fy int, fp string")
    num = spark.createDataFrame(
        NUM, "adsh string, tag string, ddate date, qtrs int, uom string, segments string, "
             "value double")
    mapping = spark.createDataFrame([("AAA", 1), ("BBB", 2)], "Symbol string, CIK bigint")
    stock = spark.createDataFrame(STOCK, "Date date, Ticker string, Close double")
    return num, sub, mapping, stock


def test_revenue_growth_filters_and_prior_year(tables):
    num, sub, mapping, _ = tables
    got = rows(kpi.revenue_growth(num, sub, mapping),
               "symbol", "fy", "fp", "quarter", "tag", "curr_revenue", "prev_revenue",
               "revenue_growth_rate")
    assert got == sorted([
        ("AAA", 2020, "FY", "FY 2020", R, 100.0, None, None),
        ("AAA", 2021, "FY", "FY 2021", R, 121.0, 100.0, 21.0),
        ("AAA", 2020, "Q1", "Q1 2020", R, 20.0, None, None),
        ("AAA", 2021, "Q1", "Q1 2021", R, 25.0, 20.0, 25.0),
        ("AAA", 2021, "Q1", "Q1 2021", "SalesRevenueNet", 26.0, 20.0, 30.0),
        ("BBB", 2019, "FY", "FY 2019", R, -50.0, None, None),
        ("BBB", 2021, "FY", "FY 2021", R, 100.0, None, None),
        ("BBB", 2020, "Q3", "Q3 2020", R, 0.0, None, None),
        ("BBB", 2021, "Q3", "Q3 2021", R, 10.0, 0.0, None),       # zero divisor -> NULL
        ("BBB", None, "Q3", "Q3 ", R, 50.0, None, None),           # NULL fy kept, no prior
    ], key=repr)


def test_quarter_selector_and_symbol_filter(tables):
    num, sub, mapping, _ = tables
    q1 = rows(kpi.revenue_growth(num, sub, mapping, quarter="Q1"), "fp")
    assert set(q1) == {("Q1",)} and len(q1) == 3
    one = rows(kpi.revenue_growth(num, sub, mapping, symbols=["AAA"]))
    everything = [r for r in rows(kpi.revenue_growth(num, sub, mapping)) if r[0] == "AAA"]
    assert one == everything


def test_cagr_latest_over_earliest(tables):
    num, sub, mapping, _ = tables
    got = {r[0]: r[1] for r in rows(kpi.revenue_cagr(num, sub, mapping), "symbol", "cagr")}
    assert got["AAA"] == pytest.approx(round(1.21 ** 0.2 - 1, 6))
    assert math.isnan(got["BBB"])  # negative ratio: fractional power is NaN
    years = {r[0]: r[1] for r in rows(
        kpi.revenue_cagr(num, sub, mapping, exponent=None), "symbol", "cagr")}
    assert years["AAA"] == pytest.approx(0.21)


def test_pe_ratio_asof_window_and_rank(tables):
    num, sub, mapping, stock = tables
    got = rows(kpi.pe_ratio(num, sub, mapping, stock),
               "symbol", "fy", "fp", "price_date", "eps", "stock_price", "pe_ratio")
    assert got == sorted([
        # 10 days back is inside the window, 11 days back is not
        ("AAA", 2020, "Q1", D(2020, 3, 21), 2.0, 40.0, 20.0),
        # zero EPS -> NULL ratio; the second filing of folder 2021q1 met an
        # older bar and loses the per-folder rank
        ("AAA", 2021, "Q1", D(2021, 3, 31), 0.0, 50.0, None),
    ], key=repr)


def test_company_filings(tables):
    _, sub, mapping, _ = tables
    got = rows(kpi.company_filings(sub, mapping, symbols=["BBB"]), "symbol", "adsh")
    assert [a for _, a in got] == sorted(a for (_, a, c, *_) in SUB if c == 2)


def test_vs_index_with_tied_first_dates(spark):
    """Two bars on a first date, of a company and of the index: both count as bases, rows multiply."""
    d = [D(2020, 1, 1), D(2020, 1, 2)]
    bars = [("A", d[0], 10.0), ("A", d[0], 20.0), ("A", d[1], 30.0), (tags.INDEX_TICKER, d[0], 100.0),
            (tags.INDEX_TICKER, d[0], 200.0), (tags.INDEX_TICKER, d[1], 400.0)]
    got = kpi.vs_index(spark.createDataFrame(bars, "Ticker string, Date date, Close double")).collect()
    last = sorted((r.company_growth, r.index_growth) for r in got if r.Date == d[1])
    assert last == [(0.5, 1.0), (0.5, 3.0), (2.0, 1.0), (2.0, 3.0)]
    assert len(got) == 4 + 2 * 2 * 2 * 2
