"""Joins of many rows with one row per key, where a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a key with one in so many of all rows is settled where its rows are; at most so many keys can be
SHARE = 1000


def join_by_key(rows: DataFrame, table: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` with the columns of ``table`` (one row per ``key``, not null; ``size``: the key's rows), inner.

    The keys with a thousandth of all rows or more, at most a thousand of them,
    are broadcast, so no task gets all rows of such a key; the others, each a
    small share of a partition, meet by an ordinary shuffle.
    """
    total = table.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    is_hot = F.col(size) * SHARE >= F.lit(total)
    hot = F.broadcast(table.filter(is_hot))
    warm = rows.join(hot, key)
    rest = rows.join(hot.select(key), key, "left_anti").join(table.filter(~is_hot), key)
    return warm.unionByName(rest).drop(size)
