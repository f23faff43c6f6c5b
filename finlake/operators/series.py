"""Ordered-series operators that stay balanced when one key is huge.

A window ``PARTITION BY ticker ORDER BY date`` puts every row of a ticker in
one task; if one ticker held a third of the data, one task would sort and
buffer a third of the data.  The helpers here avoid that:

* :func:`row_numbers` numbers rows inside (key, block of order values) -- a
  year of dates, a stretch of numbers -- and adds the rows of the key's earlier
  blocks, a sum over one row per (key, block).
* :func:`with_blocks` cuts each key's series into blocks of ``block_size``
  consecutive rows and copies the few neighbour rows a bounded frame needs
  (``ahead`` rows of the next block, ``behind`` rows of the previous one).
  Frame functions (lead/lag/rows-between) then run per (key, block): every
  window partition holds at most ``block_size + ahead + behind`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def order_block(df: DataFrame, order: str, stretch: int = 4096) -> Column:
    """A coarse value that grows with ``order``: the year of a date, ``stretch`` consecutive numbers."""
    kind, col = df.schema[order].dataType, F.col(order)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.year(col)
    if isinstance(kind, T.NumericType):
        return F.floor(col / stretch)
    return F.substring(col.cast("string"), 1, 1)


def row_numbers(df: DataFrame, key: list[str], order: str, tiebreak: list[str] | None = None,
                rn: str = "rn", count: str | None = None) -> DataFrame:
    """1-based position of each row inside ``key`` ordered by ``order`` (then ``tiebreak``)."""
    blocked = df.withColumn("_ob", order_block(df, order))
    sizes = blocked.groupBy(*key, "_ob").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*key).orderBy("_ob").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    if count:
        sizes = sizes.withColumn(count, F.sum("_n").over(Window.partitionBy(*key)))
    within = Window.partitionBy(*key, "_ob").orderBy(order, *[c for c in tiebreak or [] if c != order])
    same = (blocked["_ob"].eqNullSafe(sizes["_ob"]))
    for k in key:
        same = same & blocked[k].eqNullSafe(sizes[k])
    numbered = blocked.withColumn("_in", F.row_number().over(within))
    keep = [numbered[c] for c in df.columns]
    out = numbered.join(sizes, same).select(
        *keep, *([sizes[count]] if count else []), (sizes["_before"] + numbered["_in"]).alias(rn))
    return out


def with_blocks(df: DataFrame, rn: str, block_size: int, ahead: int = 0, behind: int = 0,
                block: str = "_block", primary: str = "_primary") -> DataFrame:
    """Assign rows to blocks of consecutive positions, copying frame neighbours.

    ``primary`` is true for a row's own block; copies are marked false and must
    be filtered out after the per-block frame functions ran.
    """
    if block_size < max(ahead, behind, 1):
        raise ValueError("block_size must be at least the frame reach")
    pos = F.col(rn) - 1
    b = F.floor(pos / block_size).cast("long")
    off = pos % block_size
    mk = lambda blk, own: F.struct(blk.alias(block), F.lit(own).alias(primary))
    copies = F.array(mk(b, True))
    if ahead:
        copies = F.when((off < ahead) & (b > 0), F.array_append(copies, mk(b - 1, False))) \
            .otherwise(copies)
    if behind:
        copies = F.when(off >= block_size - behind, F.array_append(copies, mk(b + 1, False))) \
            .otherwise(copies)
    return df.withColumn("_copy", F.explode(copies)).select("*", "_copy.*").drop("_copy")


def chronological_split(df: DataFrame, key: list[str], order: str, train_fraction: float = 0.8,
                        tiebreak: list[str] | None = None) -> DataFrame:
    """Label rows 'train' (first ``floor(fraction * n)`` per key) or 'test'.

    Adds ``rn`` (position in the key), ``n`` (rows in the key) and ``split_rn``
    (position inside the split).  Order is explicit, never the input order.
    """
    numbered = row_numbers(df, key, order, tiebreak, rn="rn", count="n")
    n_train = F.floor(F.col("n") * F.lit(train_fraction))
    return numbered.withColumns({
        "split": F.when(F.col("rn") <= n_train, "train").otherwise("test"),
        "split_rn": F.when(F.col("rn") <= n_train, F.col("rn")).otherwise(F.col("rn") - n_train),
    })


def packed(df: DataFrame, key: list[str], rn: str, cols: list[str], ahead: int, block_size: int) -> DataFrame:
    """The series as arrays: a row per (key, block) with ``_first`` (position), ``_own`` (rows of the block itself) and
    an array per column, the ``ahead`` rows behind the block included.

    A block's rows are one value each in an array, so the packed series is
    about as large as the rows, whatever frame is later read from it.
    """
    blocks = with_blocks(df, rn, block_size, ahead=ahead)
    rows = blocks.groupBy(*key, "_block").agg(
        F.array_sort(F.collect_list(F.struct(F.col(rn).alias("_rn"), *cols))).alias("_rows"),  # a block's at most
        F.count_if("_primary").alias("_own"))
    one = lambda c: F.transform("_rows", lambda x: x[c]).alias(c)
    return rows.select(*key, F.col("_rows")[0]["_rn"].alias("_first"), F.col("_own").cast("int").alias("_own"),
                       *[one(c) for c in cols])


def sequence_windows(df: DataFrame, key: list[str], rn: str, features: list[str], target: str,
                     seq_len: int, block_size: int = 1024,
                     carry: list[str] | None = None) -> DataFrame:
    """For each start position i: rows i..i+seq_len-1 as an array and row i+seq_len's target.

    Positions come from ``rn`` (1-based, consecutive within ``key``).  Only
    starts with a full window and a target are returned; a series of m rows
    gives max(m - seq_len, 0) windows.  ``carry`` columns are taken from the
    start row.  What is shuffled is the packed series; windows are read from a
    block's arrays when their rows are made.
    """
    cols = list(dict.fromkeys([*features, target, *(carry or [])]))
    blocks = packed(df, key, rn, cols, seq_len, max(block_size, seq_len))
    last = F.least(F.col("_own"), F.size(target) - seq_len)
    starts = F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>"))

    def window(i: Column) -> Column:
        return F.transform(F.sequence(i, i + seq_len - 1), lambda j: F.struct(*[F.get(c, j).alias(c) for c in features]))

    made = F.transform(starts, lambda i: F.struct(
        (F.col("_first") + i).alias(rn), *[F.get(c, i).alias(c) for c in carry or []],
        window(i).alias("window"), F.get(target, i + seq_len).alias("target")))
    return blocks.select(*key, F.inline(made)).filter(F.col("target").isNotNull())


def window_moments(df: DataFrame, key: list[str], rn: str, value: str, seq_len: int, carry: list[str] | None = None,
                   block_size: int = 8192) -> DataFrame:
    """Per window of ``seq_len`` rows its first, last and next value, its sum, and its sum by position.

    From running sums inside a block: a window's sum is a difference of two of
    them, so a row stays one row and nothing is added up twice.
    """
    blocks = with_blocks(df.select(*dict.fromkeys([*key, rn, value, *(carry or [])])), rn, max(block_size, seq_len),
                         ahead=seq_len)
    at = (F.col(rn) - F.col("_block") * max(block_size, seq_len)).cast("double")
    w = Window.partitionBy(*key, "_block").orderBy(rn)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = blocks.withColumn("_at", at).withColumns({
        "_c": F.sum(value).over(upto), "_p": F.sum(F.col(value) * F.col("_at")).over(upto)})
    end = lambda c: F.lead(c, seq_len - 1).over(w)
    rows = rows.withColumns({"last": end(value), "_ce": end("_c"), "_pe": end("_p"), "target": F.lead(value, seq_len).over(w)})
    total = F.col("_ce") - F.col("_c") + F.col(value)
    by_place = F.col("_pe") - F.col("_p") + F.col(value) * F.col("_at") - (F.col("_at") - 1) * total
    return rows.filter(F.col("_primary") & F.col("target").isNotNull()).select(
        *key, rn, *(carry or []), F.col(value).alias("first"), "last", total.alias("total"), by_place.alias("by_place"),
        "target")


def lagged(df: DataFrame, key: list[str], rn: str, cols: dict[str, tuple[str, int]],
           block_size: int = 8192) -> DataFrame:
    """Add ``name = lag(column, k)`` columns, computed per (key, block)."""
    reach = max(k for _, k in cols.values())
    blocks = with_blocks(df, rn, max(block_size, reach), behind=reach)
    w = Window.partitionBy(*key, "_block").orderBy(rn)
    out = blocks.withColumns({name: F.lag(c, k).over(w) for name, (c, k) in cols.items()})
    return out.filter(F.col("_primary")).drop("_block", "_primary")
