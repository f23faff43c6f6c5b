"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from tools.check_oracle import _rows, duck

from .conftest import SF_SMALL

#: the training-data operators have tests of their own in tests/llm
QUERIES = {k: f for k, f in entry.queries().items() if k != "pipeline" and not k.startswith("op")}
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [r.asDict(recursive=True) for r in df.collect()]
    if name not in ORACLES:
        assert df.columns  # rows-only queries: runs and has a schema
        return
    cur = con.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    cols = sorted(dcols)
    assert _rows(srows, cols) == _rows(drows, cols)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "revenue_growth_rate" in df.columns


def test_every_query_has_an_oracle_or_is_documented():
    rows_only = {"rf_forecast", "table_size"}
    assert set(QUERIES) - set(ORACLES) <= rows_only


def test_schemas_are_stable_across_calls(spark):
    for name, fn in QUERIES.items():
        if name == "rf_forecast":  # fits a model on every call; schema checked in the oracle test
            continue
        assert fn(spark, SF_SMALL).schema == fn(spark, SF_SMALL).schema, name
