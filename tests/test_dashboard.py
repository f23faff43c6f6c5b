"""The dashboard's SQL text against the functions, with and without parameters."""

import pytest

from finlake.plans import dashboard, kpi
from finlake.plans.fixtures import Fixtures

from .conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def fx(spark):
    f = Fixtures(spark, SF_SMALL)
    f.register_views()
    return f


@pytest.mark.parametrize("symbol,quarter", [(None, "All"), ("S1", "All"), ("S2", "Q1"), (None, "FY"), ("none", "All")])
@pytest.mark.parametrize("name", ["revenue_growth", "margins", "cash_flow"])
def test_text_equals_function(spark, fx, name, symbol, quarter):
    args = {"symbols": None if symbol is None else [symbol], "quarter": quarter}
    assert rows(dashboard.run(spark, name, symbol, quarter)) == rows(
        getattr(kpi, name)(fx.fs_num, fx.fs_sub, fx.mapping, **args))


@pytest.mark.parametrize("symbol,quarter", [(None, "All"), ("S1", "FY")])
@pytest.mark.parametrize("name", ["pe_ratio", "pb_ratio"])
def test_priced_text_equals_function(spark, fx, name, symbol, quarter):
    args = {"symbols": None if symbol is None else [symbol], "quarter": quarter}
    assert rows(dashboard.run(spark, name, symbol, quarter)) == rows(
        getattr(kpi, name)(fx.fs_num, fx.fs_sub, fx.mapping, fx.stock, **args))


def test_parameters_are_values_not_text(spark, fx):
    assert dashboard.run(spark, "margins", "S1' OR '1' = '1").count() == 0


def test_own_statements_with_quoted_identifiers(spark, fx):
    got = dashboard.run_text(spark, 'SELECT count(*) AS "N" FROM stock WHERE "Ticker" = :t', {"t": "S1"})
    assert got.columns == ["N"] and got.first()[0] == fx.stock.filter("Ticker = 'S1'").count()
    assert spark.sql('SELECT "text" AS x').first()[0] == "text"       # the session's own reading is unchanged
