"""Per-group min-max scaling (fit on one subset, apply to all rows).

MLlib's ``MinMaxScaler`` fits one global range; the forecast features need
one range per company fitted on its training rows only.  The fit is a
grouped min/max (partial aggregation, so a huge group costs nothing extra);
applying it is a join to one row per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def minmax_fit(df: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """One row per group: ``{c}_scale`` and ``{c}_min`` for range (0, 1).

    Same parameters as a (0, 1) min-max scaler: scale = 1 / (max - min),
    with 1 for a constant column; offset = -min * scale.
    """
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"_{c}_lo"), F.max(c).alias(f"_{c}_hi")]
    stats = df.groupBy(*key).agg(*aggs)
    out = []
    for c in cols:
        rng = F.col(f"_{c}_hi") - F.col(f"_{c}_lo")
        scale = F.lit(1.0) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)
        out += [scale.alias(f"{c}_scale"), (-F.col(f"_{c}_lo") * scale).alias(f"{c}_min")]
    return stats.select(*key, *out)


def scaled(c: str) -> Column:
    return F.col(c) * F.col(f"{c}_scale") + F.col(f"{c}_min")


def unscaled(value: Column, c: str) -> Column:
    return (value - F.col(f"{c}_min")) / F.col(f"{c}_scale")


def minmax_transform(df: DataFrame, params: DataFrame, key: list[str], cols: list[str],
                     keep_params: bool = False) -> DataFrame:
    """Replace ``cols`` by their scaled values (rows of unfitted groups drop out)."""
    j = df.join(params, key)
    out = j.withColumns({c: scaled(c) for c in cols})
    if not keep_params:
        out = out.drop(*[f"{c}_{p}" for c in cols for p in ("scale", "min")])
    return out
