"""Operator 4: mix sources to target weights by systematic sampling.

Each document of a source has the same expected number of copies, target words
divided by the source's words.  The documents of a source stand in a fixed
order (size, then id); the prefix sum of expected copies plus one offset in
[0, 1) per source crosses an integer once for each copy that is emitted.
Ordering by size spreads the copies evenly over short and long documents, so
the words taken come within about one long document of the target.

The prefix sum never gathers a source in one task: the rows are dealt to ranges
of (source, size, id) and each range counts on its own (``ordering.numbered``),
so a source, a size or an id of any share of the rows spreads over many tasks.
Only counts are ever summed per source.

The last step emits the documents: a document's whole row, once per copy.  Rows
are written with a number of their own and meet their copies by it.

Defined cases: null or empty text has size 0, takes 0 words and keeps its row;
a null source is a source of its own, last in order; rows that repeat an id are
sampled independently (rows of equal size and id are ranked by the hash of their
text, then of the whole row); an empty table gives an empty result; columns of
the input that clash with the result's are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm.hot import join_by_key
from finlake.llm.ordering import numbered
from finlake.llm.store import stored

#: a word: no blank, tab, line feed, vertical tab, form feed or carriage return
WORD = r"[^\x20\x09-\x0D]+"

def n_words(text: Column) -> Column:
    """Words of a text (0 for null)."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(per_source: DataFrame, weights: tuple[int, ...], most: float) -> DataFrame:
    """``target`` per source: shares of all sizes by weight, at most ``most`` times its size.

    ``per_source``: one row per source (``source``, ``source_size``); sources in
    code-point order, null last, take the weights in turn.  Sharing the excess
    again and again ends at ``min(level * weight, cap)`` for one common level;
    in the order of cap/weight the capped sources come first, so the level is
    the first one that the next source's cap is not below.
    """
    one = F.lit(1)
    by_name = Window.partitionBy(one).orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    number = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = per_source.select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(w) for w in weights]), (number + 1).cast("int")).cast("long").alias("_w"))
    ratio = Window.partitionBy(one).orderBy(F.col("source_size") / F.col("_w"), F.col("source").isNull(),
                                            F.col("source").cast("binary"))
    upto, whole = ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(one)
    s, w = F.col("source_size"), F.col("_w")
    total = F.sum(s).over(whole)
    rest_words = total - most * F.coalesce(F.sum(s).over(upto), F.lit(0))
    rest_weight = F.sum(w).over(whole) - F.coalesce(F.sum(w).over(upto), F.lit(0))
    level = weighted.select("source", "source_size", "_w", (rest_words / rest_weight).alias("_level"))
    # of the levels that leave their source open the first one is the largest
    common = F.max(F.when(F.col("_level") * w <= most * s, F.col("_level"))).over(whole)
    cap = (most * s).cast("double")
    return level.select("source", "source_size", F.coalesce(F.least(common * w, cap), cap).alias("target"))


def offset(source: Column, seed: int) -> Column:
    """The source's random offset in [0, 1), the same on every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _ranked(docs: DataFrame, columns: list[str], weights: tuple[int, ...], most: float, seed: int,
            every: bool = True) -> DataFrame:
    """``row`` (the given columns), ``source, rank, size, source_size, target, copies``; one row per document."""
    whole = [f"`{f.name}`" for f in docs.schema if _hashable(f.dataType)]
    source, doc = F.col("source").cast("string"), F.col("doc_id")
    rows = stored(docs.select(
        F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("_g"), source.alias("source"),
        n_words(F.col("text")).alias("size"), doc.isNull().alias("_none"), doc.cast("long").alias("_id"),
        F.xxhash64("text").alias("_t"), F.xxhash64(*whole).alias("_h"),
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")).withColumn(
            "_row", F.monotonically_increasing_id()), "rows")
    # the longest documents of a source follow each other, so whole rows are not dealt to these ranges
    slim = numbered(rows.drop("row"), ["size", "_none", "_id", "_t", "_h"], "ranked")
    per_source = slim.groupBy("_g", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    goal = targets(per_source.select("source", "source_size"), weights, most)
    goal = per_source.alias("p").join(goal.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source"))).select(
        "p._g", "p._n", "p.source_size", "g.target")
    made = join_by_key(slim.withColumn("rank", F.col("_pos") + 1), goal, "_g", "_n")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = offset(F.col("source"), seed)
    copies = F.floor(F.col("rank") * rate + u) - F.floor((F.col("rank") - 1) * rate + u)
    made = made.select("_row", "source", "rank", "size", "source_size", "target",
                       F.least(copies, F.ceil(F.lit(most))).cast("long").alias("copies"))
    if not every:
        made = made.filter("copies > 0")
    return made.join(rows.select("_row", "row"), "_row").drop("_row")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: float = 3.0, seed: int = 17) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``."""
    return _ranked(docs, ["doc_id"], weights, most, seed).select(
        "row.doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def emit(docs: DataFrame, columns: list[str] | None = None, every: bool = False, weights: tuple[int, ...] = (5, 2, 1),
         most: float = 3.0, seed: int = 17) -> DataFrame:
    """The mixed corpus: ``row`` (``columns`` of the input, or all), ``source, rank, size, source_size, target, copies,
    copy``; one row per copy, ``copy`` from 1 to ``copies``.  With ``every``, documents without a copy stay, once, with
    a null ``copy``.
    """
    one = _ranked(docs, columns or docs.columns, weights, most, seed, every)
    numbers = F.when(F.col("copies") > 0, F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return one.withColumn("copy", (F.explode_outer if every else F.explode)(numbers))


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` per document, counted from what ``emit`` emits."""
    copies = emit(docs, ["doc_id"], every=True)
    one = copies.groupBy("source", "rank").agg(
        F.first("row").alias("row"), F.first("size").alias("size"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"), F.count("copy").alias("_n"))
    return one.select("row.doc_id", "size", "source_size", "target", (F.col("_n") * F.col("size")).alias("taken"))
