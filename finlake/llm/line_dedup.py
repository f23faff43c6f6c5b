"""Operator 9: remove repeated runs of three lines.

A document's lines are its text split at line feeds.  Every three consecutive
lines form a window; a window is the later occurrence of a repeat if an equal
one stands earlier (smaller id, or same document and earlier line).  The lines
covered by later occurrences are merged and removed, so a passage of three or
more lines survives only where it stands first.

Windows are grouped by 128 bits of hash (two hashes with different prefixes).
The first place of each repeated window comes from a partially aggregated
minimum; windows then join it, so a window that half the corpus repeats is one
row on the unique side, and the other side is an ordinary shuffled join that
AQE may split.  Only repeated windows travel further.

Defined cases: null text stays null and has no lines; texts of one or two lines
are never changed; windows whose three lines are all blank do not count; rows
that repeat an id are ordered by their text's hash, and equal rows (same id,
same text) are one document; null ids sort last; extra columns are kept, inside
``row``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm.store import row_key

#: lines per window
WIDTH = 3


def _windows(docs: DataFrame) -> DataFrame:
    """``_h, _g`` (hash halves), ``_d, _t, _i`` (row and first line) per window."""
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    base = docs.select(*row_key(F.col("doc_id"), F.col("text")), lines.alias("_lines")).filter(
        F.size("_lines") >= WIDTH)

    def hashed(i: Column) -> Column:
        three = [F.get(F.col("_lines"), i + k) for k in range(WIDTH)]
        full = F.trim(F.regexp_replace(F.concat(*three), r"[\x09-\x0D]", "")) != ""
        return F.when(full, F.struct(F.xxhash64(*three).alias("h"), F.xxhash64(F.lit("#"), *three).alias("g"),
                                     i.alias("i")))

    at = F.sequence(F.lit(0), F.size("_lines") - WIDTH)
    return base.select("_d", "_t", F.explode(F.transform(at, hashed)).alias("w")).filter(
        F.col("w").isNotNull()).select("_d", "_t", F.col("w.h").alias("_h"), F.col("w.g").alias("_g"),
                                       F.col("w.i").alias("_i"))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Per document with removals: ``_d, _t`` and ``_covered``, its removed line numbers."""
    win = _windows(docs)
    place = F.struct("_d", "_t", "_i")
    first = win.groupBy("_h", "_g").agg(F.min(place).alias("_first"), F.max(place).alias("_last")).filter(
        F.col("_first") < F.col("_last")).drop("_last")
    later = win.join(first, ["_h", "_g"]).filter(place > F.col("_first"))
    covered = F.array_distinct(F.flatten(F.collect_set(
        F.array(*[F.col("_i") + k for k in range(WIDTH)]))))
    return later.groupBy("_d", "_t").agg(covered.alias("_covered"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``row`` (the document's columns, the repeated lines taken out of ``text``), ``n_lines``, ``n_removed``."""
    keyed = docs.select(*row_key(F.col("doc_id"), F.col("text")), F.struct("*").alias("row"))
    spans = repeated_lines(docs)
    joined = keyed.join(spans, ["_d", "_t"], "left").select(
        "row", "_covered", F.split("row.text", "\n", -1).alias("_lines"))
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    # by a hash set, not line by line through the list: long texts have many of both
    left = F.transform(F.array_except(every, F.col("_covered")), lambda i: F.get(F.col("_lines"), i))
    text = F.when(F.col("_covered").isNull(), F.col("row.text")).otherwise(F.concat_ws("\n", left))
    return joined.select(
        F.col("row").withField("text", text).alias("row"),
        F.when(F.col("row.text").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("_covered"), F.lit(0)).cast("long").alias("n_removed"))
