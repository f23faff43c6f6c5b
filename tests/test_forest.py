"""The forest against a plain version, ARIMA orders against least squares, window moments against slices."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest

from finlake.operators.series import packed, window_moments
from finlake.plans import forecast, forest

from .conftest import rows as sorted_rows

NAMES = [n for n, *_ in forest.FEATURES]
SCHEMA = "y long, h string, " + ", ".join(f"{n} int" for n in NAMES)


def data(n, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        x = [r.randrange(forest.BINS) for _ in NAMES[:-1]] + [r.randrange(3)]
        y = 1000 * x[0] + 300 * (x[4] > 15) * x[1] + 5000 * (x[8] == 2) + r.randint(-50, 50)
        out.append((y, hashlib.md5(str(i).encode()).hexdigest(), *x))
    return out


def slow_tree(rows, tree, depth):
    splits, own = {}, {1: [r for r in rows if r[1][tree] < "a"]}
    for level in range(depth):
        for node in [k for k in own if k >= 2**level]:
            part = own[node]
            best = None
            for f in range(len(NAMES)):
                if (7 * tree + 5 * f) % 3 == 0:
                    continue
                for b in sorted({r[2 + f] for r in part}):
                    left, right = [r[0] for r in part if r[2 + f] <= b], [r[0] for r in part if r[2 + f] > b]
                    if len(left) >= forest.LEAST_ROWS and len(right) >= forest.LEAST_ROWS:
                        gain = sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right)
                        if best is None or gain > best[0]:
                            best = (gain, f, b)
            if best:
                _, f, b = best
                splits[node] = (f, b)
                own[2 * node] = [r for r in part if r[2 + f] <= b]
                own[2 * node + 1] = [r for r in part if r[2 + f] > b]
                del own[node]
    return splits, {k: int(Fraction(sum(r[0] for r in v), len(v)) + Fraction(1, 2)) for k, v in own.items()}


@pytest.mark.parametrize("n,trees,depth", [(400, 5, 3), (25, 2, 2), (15, 1, 2)])
def test_forest_equals_a_plain_one(spark, n, trees, depth):
    rows = data(n)
    got = forest.grow(spark.createDataFrame(rows, SCHEMA).repartition(3), trees, depth)
    assert len(got) == trees
    for t, (splits, leaves) in enumerate(got):
        want_splits, want_leaves = slow_tree(rows, t, depth)
        assert splits == want_splits
        assert {k: abs(v - want_leaves[k]) <= 1 for k, v in leaves.items()} == dict.fromkeys(want_leaves, True)


def test_predictions_walk_the_trees(spark):
    rows = data(300, 2)
    df = spark.createDataFrame(rows, SCHEMA)
    grown = forest.grow(df, 3, 4)

    def walk(x):
        total = 0
        for splits, leaves in grown:
            node = 1
            while node in splits:
                f, b = splits[node]
                node = 2 * node + (x[2 + f] > b)
            total += leaves[node]
        return total / (len(grown) * forest.UNIT)
    got = sorted(r[0] for r in df.select(forest.prediction(grown)).collect())
    assert np.allclose(got, sorted(map(walk, rows)))
    spread = np.var([r[0] for r in rows])
    missed = np.mean([(r[0] - walk(r) * forest.UNIT) ** 2 for r in rows])
    assert missed < 0.4 * spread


def test_no_training_rows(spark):
    assert forest.grow(spark.createDataFrame([], SCHEMA)) == []


def test_arima_orders_equal_least_squares(spark):
    r = np.random.default_rng(5)
    rows, series = [], {}
    for t, (phi, theta) in {"A": (0.7, 0.0), "B": (0.0, -0.6), "C": (0.0, 0.0), "SHORT": (0.0, 0.0)}.items():
        e = r.standard_normal(1200)
        d = np.zeros(1200)
        for k in range(1, 1200):
            d[k] = 0.1 + phi * d[k - 1] + e[k] + theta * e[k - 1]
        close = 500 + np.cumsum(d)[: 12 if t == "SHORT" else 1200]
        series[t] = close
        rows += [(f"2000-01-01", k, t, float(c)) for k, c in enumerate(close)]
    df = spark.createDataFrame(rows, "base string, k int, Ticker string, Close double").selectExpr(
        "date_add(to_date(base), k) AS Date", "Ticker", "Close")
    got = {(x.Ticker, x.p, x.q): x for x in forecast.arima_orders(df).collect()}
    for t, close in series.items():
        d = np.diff(close)
        y, d1, d2, d3 = d[3:], d[2:-1], d[1:-2], d[:-3]
        train = np.arange(4, len(close)) < int(len(close) * 0.8)
        fit = lambda cols, target: np.linalg.lstsq(np.stack([np.ones(len(target)), *cols], 1), target, rcond=None)[0]
        if t == "SHORT":
            assert all(got[t, p, q].aic is None for p, q in forecast.ORDERS)
            continue
        a = fit([d1[train], d2[train]], y[train])
        e = d1 - a[0] - a[1] * d2 - a[2] * d3
        for p, q in forecast.ORDERS:
            cols = [d1, d2][:p] + [e] * q
            b = fit([c[train] for c in cols], y[train])
            left = y[train] - b[0] - sum(w * c[train] for w, c in zip(b[1:], cols))
            aic = train.sum() * np.log(np.mean(left**2)) + 2 * (len(cols) + 1)
            x = got[t, p, q]
            assert x.n_train == train.sum() and abs(x.aic - aic) < 0.01 and abs(x.c - b[0]) < 1e-3
    best = {x.Ticker: (x.p, x.q) for x in forecast.arima_choice(df).collect()}
    assert best["A"][0] >= 1 and best["B"] != (0, 0) and "SHORT" not in best


def test_window_moments_equal_slices(spark):
    r = random.Random(2)
    rows = [(t, k + 1, r.random()) for t, n in (("a", 137), ("b", 8), ("c", 9), ("d", 3)) for k in range(n)]
    df = spark.createDataFrame(rows, "t string, rn long, v double").repartition(4)
    got = {(x.t, x.rn): x for x in window_moments(df, ["t"], "rn", "v", 8, block_size=16).collect()}
    want = 0
    for t in "abcd":
        v = [x for k, _, x in rows if k == t]
        for i in range(max(len(v) - 8, 0)):
            x, part = got[t, i + 1], v[i:i + 8]
            assert (x.first, x.last, x.target) == (part[0], part[-1], v[i + 8])
            assert abs(x.total - sum(part)) < 1e-9 and abs(x.by_place - sum((j + 1) * y for j, y in enumerate(part))) < 1e-9
            want += 1
    assert len(got) == want


def test_packed_series_is_about_as_large_as_its_rows(spark):
    df = spark.range(1, 3001).selectExpr("'t' AS t", "id AS rn", "id * 2 AS v")
    blocks = packed(df, ["t"], "rn", ["v"], ahead=50, block_size=1000).collect()
    assert [(b["_first"], b["_own"], len(b.v)) for b in sorted(blocks, key=lambda b: b["_first"])] == [
        (1, 1000, 1050), (1001, 1000, 1050), (2001, 1000, 1000)]
    assert sorted_rows(df.select("v")) == sorted({(v,) for b in blocks for v in b.v}, key=repr)
