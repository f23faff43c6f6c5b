"""Forecast baselines on the prepared features.

* ARIMA(1,1,0) per company by least squares: the daily change is regressed on
  the previous day's change over the training rows (``regr_slope`` /
  ``regr_intercept``, grouped -- partial aggregation keeps a huge company
  cheap), then one-step forecasts are scored on the test rows.
* ARIMA(p,1,q) with the order chosen per company by Akaike's criterion: the
  moving-average term by Hannan and Rissanen's two regressions, every model's
  normal equations from the same grouped moments.
* The random forest is in :mod:`finlake.plans.forest`.

Errors are reported per company as MSE and RMSE in price units, the
equivalent of inverting the min-max scaling before ``mean_squared_error``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions.scalar import rounded
from finlake.operators.scaling import unscaled
from finlake.operators.series import chronological_split, lagged
from finlake.session import cut_lineage

KEY = ["Ticker"]


def arima_110(stock: DataFrame, train_fraction: float = 0.8) -> DataFrame:
    """Per ticker: slope/intercept of the AR(1) on differences and test-set error."""
    bars = stock.select("Ticker", "Date", "Close")
    split = chronological_split(bars, KEY, "Date", train_fraction, ["Date", "Close"])
    lags = lagged(split, KEY, "rn", {"_c1": ("Close", 1), "_c2": ("Close", 2)})
    lags = lags.withColumns({
        "_d": F.col("Close") - F.col("_c1"),
        "_d1": F.col("_c1") - F.col("_c2"),
    })
    train = lags.filter(F.col("split") == "train")
    fit = train.groupBy(*KEY).agg(
        F.regr_slope("_d", "_d1").alias("phi"),
        F.regr_intercept("_d", "_d1").alias("c"),
        F.count(F.lit(1)).alias("n_train"),
    )
    test = lags.filter(F.col("split") == "test").join(fit, KEY)
    pred = F.col("_c1") + F.col("c") + F.col("phi") * F.col("_d1")
    err = (F.col("Close") - pred)
    scored = test.withColumn("_se", err * err)
    out = scored.groupBy(*KEY).agg(
        F.first("phi").alias("phi"), F.first("c").alias("c"), F.first("n_train").alias("n_train"),
        F.count("_se").alias("n_test"),
        F.avg("_se").alias("_mse"),
    )
    return out.select(
        *KEY, rounded(F.col("phi")).alias("phi"), rounded(F.col("c")).alias("c"),
        "n_train", "n_test", rounded(F.sqrt("_mse"), 4).alias("rmse"),
    )


#: (p, q) of the ARIMA(p, 1, q) models compared
ORDERS = ((0, 0), (1, 0), (2, 0), (0, 1), (1, 1))
#: training rows that a comparison needs, and the least share of the changes' variance that an error variance is
LEAST_ROWS, LEAST_VARIANCE = 20, 1e-9


def _solved(terms: list[str], y: str = "d") -> dict[str, F.Column]:
    """Least-squares coefficients of ``y`` on at most two regressors from their grouped moments."""
    cov = lambda a, b: F.col("c_" + "_".join(sorted((a, b))))
    if not terms:
        return {}
    if len(terms) == 1:
        return {terms[0]: F.try_divide(cov(terms[0], y), cov(terms[0], terms[0]))}
    a, b = terms
    det = cov(a, a) * cov(b, b) - cov(a, b) * cov(a, b)
    return {a: F.try_divide(cov(a, y) * cov(b, b) - cov(b, y) * cov(a, b), det),
            b: F.try_divide(cov(b, y) * cov(a, a) - cov(a, y) * cov(a, b), det)}


def _moments(rows: DataFrame, names: list[str]) -> DataFrame:
    """Per company the count, means and covariances: sums that are added up before anything is shuffled."""
    pairs = sorted({tuple(sorted((a, b))) for a in names for b in names})
    return rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), *[F.avg(x).alias(f"m_{x}") for x in names],
                                  *[F.covar_pop(a, b).alias(f"c_{a}_{b}") for a, b in pairs])


def _differences(stock: DataFrame, train_fraction: float) -> DataFrame:
    """Bars with the day's change ``d`` and the three before it (``d1`` to ``d3``); only rows that have them all."""
    split = chronological_split(stock.select("Ticker", "Date", "Close"), KEY, "Date", train_fraction, ["Date", "Close"])
    lags = lagged(split, KEY, "rn", {f"_c{k}": ("Close", k) for k in range(1, 5)})
    closes = ["Close", *[f"_c{k}" for k in range(1, 5)]]
    named = {f"d{k or ''}": F.col(a) - F.col(b) for k, (a, b) in enumerate(zip(closes, closes[1:]))}
    return lags.withColumns(named).filter(F.col("d3").isNotNull()).select(
        *KEY, "Date", "rn", "split", "Close", "_c1", *named)


def _with_shock(stock: DataFrame, train_fraction: float) -> DataFrame:
    """The differences with ``e``: what a longer autoregression, fitted on the training rows, missed the day before.

    The first step of Hannan and Rissanen: its residuals stand for the shocks
    of the moving-average term, which then is one more regressor.
    """
    rows = cut_lineage(_differences(stock, train_fraction))
    first = _moments(rows.filter(F.col("split") == "train"), ["d", "d1", "d2"])
    long = _solved(["d1", "d2"])
    fit = first.select(*KEY, long["d1"].alias("_a1"), long["d2"].alias("_a2"),
                       (F.col("m_d") - long["d1"] * F.col("m_d1") - long["d2"] * F.col("m_d2")).alias("_a0"))
    return rows.join(fit, KEY).withColumn(
        "e", F.col("d1") - F.col("_a0") - F.col("_a1") * F.col("d2") - F.col("_a2") * F.col("d3")).drop("_a0", "_a1", "_a2")


def _fits(rows: DataFrame) -> DataFrame:
    """Per company and order the coefficients and Akaike's criterion, from one grouped pass over the training rows."""
    moments = _moments(rows.filter(F.col("split") == "train"), ["d", "d1", "d2", "e"])
    models = []
    for p, q in ORDERS:
        terms = [f"d{k}" for k in range(1, p + 1)] + ["e"] * q
        b = _solved(terms)
        names = lambda x: F.col("c_" + "_".join(sorted((x, "d"))))
        left = F.col("c_d_d")
        const = F.col("m_d")
        for x in terms:
            left = left - b[x] * names(x)
            const = const - b[x] * F.col(f"m_{x}")
        models.append(F.struct(
            F.lit(p).alias("p"), F.lit(q).alias("q"), const.alias("c"),
            *[F.coalesce(b.get(x, F.lit(0.0)), F.lit(0.0)).alias(out) for x, out in (
                ("d1", "phi1"), ("d2", "phi2"), ("e", "theta"))],
            (F.col("n") * F.log(F.when((F.col("n") >= LEAST_ROWS) & (left > LEAST_VARIANCE * F.col("c_d_d")), left))
             + 2.0 * (len(terms) + 1)).alias("aic")))
    return moments.select(*KEY, F.col("n").alias("n_train"), F.explode(F.array(*models)).alias("m")).select(
        *KEY, "n_train", "m.*")


def arima_orders(stock: DataFrame, train_fraction: float = 0.8) -> DataFrame:
    """Every company and order with its fit; too few rows, or a perfect fit, have no criterion."""
    fits = _fits(_with_shock(stock, train_fraction))
    return fits.select(*KEY, "p", "q", "n_train", *[rounded(F.col(x), 8).alias(x) for x in (
        "c", "phi1", "phi2", "theta")], rounded(F.col("aic"), 3).alias("aic"))


def arima_choice(stock: DataFrame, train_fraction: float = 0.8) -> DataFrame:
    """Per company the order with the least criterion (ties: the smaller model) and its one-step error on the test rows."""
    rows = cut_lineage(_with_shock(stock, train_fraction))
    best = _fits(rows).filter(F.col("aic").isNotNull()).groupBy(*KEY).agg(F.min(F.struct(
        "aic", (F.col("p") + F.col("q")).alias("size"), "q", "p", "c", "phi1", "phi2", "theta", "n_train")).alias("b"))
    test = rows.filter(F.col("split") == "test").join(best, KEY)
    err = F.col("d") - F.col("b.c") - F.col("b.phi1") * F.col("d1") - F.col("b.phi2") * F.col("d2") - F.col("b.theta") * F.col("e")
    scored = test.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_test"), F.avg(err * err).alias("_mse"))
    return best.join(scored, KEY, "left").select(
        *KEY, "b.p", "b.q", "b.n_train", F.coalesce("n_test", F.lit(0).cast("long")).alias("n_test"),
        rounded(F.col("b.aic"), 3).alias("aic"), rounded(F.sqrt("_mse"), 4).alias("rmse"))


def scaled_naive_mse(scaled: DataFrame, params: DataFrame) -> DataFrame:
    """Per company: the last scaled close as forecast of the next, both scaled back, and the error on the test rows."""
    test = scaled.filter(F.col("split") == "test").select(*KEY, "split_rn", "Close")
    lags = lagged(test, KEY, "split_rn", {"_prev": ("Close", 1)}).filter(F.col("_prev").isNotNull())
    priced = lags.join(params, KEY)
    err = unscaled(F.col("Close"), "Close") - unscaled(F.col("_prev"), "Close")
    out = priced.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_test"), F.avg(err * err).alias("_mse"))
    return out.select(*KEY, "n_test", rounded(F.col("_mse"), 3).alias("mse"), rounded(F.sqrt("_mse"), 4).alias("rmse"))
