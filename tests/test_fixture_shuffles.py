"""What the stored filing and price tables shuffle and read: narrow rows once, lineitem once for all filing tables."""

import datetime as dt
import tempfile

from .conftest import SF_SMALL
from finlake.plans import fixtures as fx


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanged_sums(df):
    """Partial sums that a shuffle takes."""
    lines = plan(df).splitlines()
    return [b for a, b in zip(lines, lines[1:]) if "Exchange" in a and "Aggregate" in b and "partial_" in b]


def test_filing_tables_read_the_stored_measures(spark):
    f = fx.Fixtures(spark, SF_SMALL)
    for df in (fx.fs_sub(f.measures), fx.fs_num_raw(f.measures)):
        assert not [p for p in df.inputFiles() if "lineitem" in p]


def test_measures_shuffle_lines(spark):
    assert not exchanged_sums(fx.quarter_measures(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")))


def test_bars_shuffle_lines_and_keep_first_and_last(spark):
    day = dt.date(1995, 3, 1)
    rows = [(1, day, 5, 1, 9, 2.0, 7.0), (1, day, 4, 2, 9, 1.0, 9.0), (1, day, 6, None, 9, 1.0, None),
            (1, day, 6, 1, 8, 3.0, 3.0), (None, day, 1, 1, 1, 1.0, 4.0), (None, day, 1, 1, 1, 1.0, 5.0),
            (2, None, 1, 1, 1, 2.0, 6.0)]
    path = tempfile.mkdtemp(prefix="finlake-test-", dir="/tmp") + "/lineitem"
    spark.createDataFrame(rows, "l_suppkey long, l_shipdate date, l_orderkey long, l_linenumber int, l_partkey long, "
                                "l_quantity double, l_extendedprice double").write.parquet(path)
    bars = fx.stock(spark.read.parquet(path)).filter("Ticker <> '^GSPC' or Ticker is null")
    assert len(exchanged_sums(fx.stock(spark.read.parquet(path)))) <= 1  # the index: a row per day and task
    got = {(r.Ticker, r.Date): (r.Close, r.High, r.Low, r.Open, r.Volume) for r in bars.collect()}
    assert got[("S1", day)] == (3.0, 9.0, 3.0, 9.0, 7) and got[("S2", None)] == (6.0, 6.0, 6.0, 6.0, 2)
