"""Ordered-series operators against a plain pandas computation."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from finlake.operators.scaling import minmax_fit, minmax_transform
from finlake.operators.series import (
    chronological_split, lagged, row_numbers, sequence_windows, with_blocks)
from finlake.plans.forecast import arima_110


def _bars(spark):
    rng = np.random.default_rng(3)
    recs = []
    start = dt.date(2020, 1, 1)
    # one hot ticker with most rows, a constant one, a short one, one of seq_len+1
    for ticker, n in (("HOT", 157), ("FLAT", 30), ("SHORT", 4), ("EDGE", 6)):
        close = 100 + np.cumsum(rng.normal(0, 1, n)) if ticker != "FLAT" else np.full(n, 7.0)
        for i in range(n):
            recs.append((start + dt.timedelta(days=i), ticker, float(round(close[i], 2))))
    return spark.createDataFrame(recs, "Date date, Ticker string, Close double")


def test_row_numbers_match_dense_order(spark):
    df = _bars(spark)
    got = row_numbers(df, ["Ticker"], "Date", rn="rn", count="n").toPandas()
    pdf = df.toPandas().sort_values(["Ticker", "Date"])
    pdf["rn"] = pdf.groupby("Ticker").cumcount() + 1
    m = got.merge(pdf, on=["Ticker", "Date"], suffixes=("", "_want"))
    assert len(m) == len(pdf)
    assert (m["rn"] == m["rn_want"]).all()
    assert (m["n"] == m.groupby("Ticker")["Date"].transform("count")).all()


def test_row_numbers_break_ties_within_a_day(spark):
    df = spark.createDataFrame(
        [("X", dt.date(2020, 1, 1), 3), ("X", dt.date(2020, 1, 1), 1), ("X", dt.date(2020, 1, 2), 0)],
        "k string, d date, v int")
    got = sorted(tuple(r) for r in row_numbers(df, ["k"], "d", ["v"]).select("v", "rn").collect())
    assert got == [(0, 3), (1, 1), (3, 2)]


def test_blocks_copy_only_the_frame_reach(spark):
    df = spark.range(1, 21).withColumnRenamed("id", "rn")
    b = with_blocks(df, "rn", 5, ahead=2, behind=1)
    assert b.filter("_primary").count() == 20
    copies = sorted(tuple(r) for r in b.filter("not _primary").select("rn", "_block").collect())
    # first two rows of blocks 1..3 go back one block; last row of each block goes forward
    assert copies == sorted(
        [(6, 0), (7, 0), (11, 1), (12, 1), (16, 2), (17, 2), (5, 1), (10, 2), (15, 3), (20, 4)])


@pytest.mark.parametrize("block", [5, 64])
def test_sequence_windows_equal_brute_force(spark, block):
    seq_len = 5
    df = row_numbers(_bars(spark), ["Ticker"], "Date", rn="rn")
    win = sequence_windows(df, ["Ticker"], "rn", ["Close"], "Close", seq_len, block_size=block,
                           carry=["Date"])
    got = {(r.Ticker, r.rn): ([x.Close for x in r.window], r.target) for r in win.collect()}
    want = {}
    for t, g in df.toPandas().sort_values("rn").groupby("Ticker"):
        c = g["Close"].tolist()
        for i in range(len(c) - seq_len):
            want[(t, i + 1)] = (c[i:i + seq_len], c[i + seq_len])
    assert got == want
    assert not any(k[0] == "SHORT" for k in got)           # fewer rows than seq_len + 1
    assert sum(k[0] == "EDGE" for k in got) == 1           # exactly seq_len + 1 rows


def test_lagged_equal_shift(spark):
    df = row_numbers(_bars(spark), ["Ticker"], "Date", rn="rn")
    got = lagged(df, ["Ticker"], "rn", {"c1": ("Close", 1), "c2": ("Close", 2)}, block_size=7)
    pdf = got.toPandas().sort_values(["Ticker", "rn"])
    for _, g in pdf.groupby("Ticker"):
        assert g["c1"].tolist()[1:] == g["Close"].tolist()[:-1]
        assert g["c2"].tolist()[2:] == g["Close"].tolist()[:-2]
        assert pd.isna(g["c1"].iloc[0]) and pd.isna(g["c2"].iloc[:2]).all()


def test_split_and_scaler(spark):
    split = chronological_split(_bars(spark), ["Ticker"], "Date", 0.8)
    counts = {(r.Ticker, r.split): r["count"] for r in split.groupBy("Ticker", "split").count().collect()}
    assert counts[("HOT", "train")] == int(157 * 0.8) and counts[("HOT", "test")] == 157 - 125
    assert counts[("SHORT", "train")] == 3
    params = minmax_fit(split.filter(F.col("split") == "train"), ["Ticker"], ["Close"])
    scaled = minmax_transform(split, params, ["Ticker"], ["Close"]).toPandas()
    train = scaled[(scaled.split == "train") & (scaled.Ticker == "HOT")]
    assert train.Close.min() == pytest.approx(0.0) and train.Close.max() == pytest.approx(1.0)
    flat = scaled[scaled.Ticker == "FLAT"]
    assert (flat.Close == 0.0).all()  # constant series: range 1, offset -min


def test_arima_on_a_linear_trend(spark):
    # close grows by 1, 2, 3, ...: changes follow d_t = d_{t-1} + 1 -> phi 1, c 1, no error
    recs = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), "T", float(i * (i + 1) // 2))
            for i in range(40)]
    df = spark.createDataFrame(recs, "Date date, Ticker string, Close double")
    r = arima_110(df).collect()[0]
    assert r.phi == pytest.approx(1.0) and r.c == pytest.approx(1.0)
    assert r.n_train == 32 and r.n_test == 8 and r.rmse == pytest.approx(0.0)


def test_inverse_scaling_and_saved_training_data(spark, scratch):
    from finlake.operators.scaling import unscaled
    from finlake.plans.features import save_training_data

    split = chronological_split(_bars(spark), ["Ticker"], "Date", 0.8)
    params = minmax_fit(split.filter(F.col("split") == "train"), ["Ticker"], ["Close"])
    scaled = minmax_transform(split.withColumn("raw", F.col("Close")), params, ["Ticker"],
                              ["Close"], keep_params=True)
    back = scaled.select((unscaled(F.col("Close"), "Close") - F.col("raw")).alias("d"))
    assert max(abs(r.d) for r in back.collect()) < 1e-9
    win = sequence_windows(scaled, ["Ticker", "split"], "split_rn", ["Close"], "Close", 5)
    save_training_data(win, params, scratch)
    assert spark.read.parquet(f"{scratch}/windows").count() == win.count()
    assert spark.read.parquet(f"{scratch}/scalers").count() == 4


def test_hot_ticker_partitions_stay_bounded(spark):
    """One ticker with 40% of the rows (5 per day): every window partition stays bounded."""
    recs = [("HOT", dt.date(1990, 1, 1) + dt.timedelta(days=i // 5), float(i)) for i in range(6000)]
    recs += [(f"C{t}", dt.date(2000, 1, 1) + dt.timedelta(days=i), float(i))
             for t in range(30) for i in range(300)]
    df = spark.createDataFrame(recs, "Ticker string, Date date, Close double")
    numbered = row_numbers(df, ["Ticker"], "Date", ["Close"], rn="rn")
    hot = sorted(r.rn for r in numbered.filter("Ticker = 'HOT'").select("rn").collect())
    assert hot == list(range(1, 6001))
    # the per-ticker window runs over one row per (ticker, day): 1,200 for HOT, not 6,000
    per_day_rows = df.groupBy("Ticker", "Date").count().filter("Ticker = 'HOT'").count()
    assert per_day_rows == 1200
    # frame functions run per (ticker, block): at most block + reach rows each
    blocks = with_blocks(numbered, "rn", 1000, ahead=50)
    sizes = [r["count"] for r in blocks.groupBy("Ticker", "_block").count().collect()]
    assert max(sizes) <= 1050 and len(sizes) == 6 + 30
