"""Most frequent label per group, with every tied label kept, then a tie rule.

Spark's ``mode`` returns a single value; the forecast features need the full
set of tied labels.  Labels are counted per (group, label) with partial
aggregation, so a hot group costs no more than any other; the counts, one per
label, then meet per group.  Every label counts, whatever its name; NULL is no
label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rule that turns a set of tied labels (in ascending order)
# into one label.
LABELS = ("negative", "neutral", "positive")
TIE_RULE = {
    ("negative", "neutral", "positive"): "neutral",
    ("negative", "neutral"): "negative",
    ("negative", "positive"): "neutral",
    ("neutral", "positive"): "positive",
}
EMPTY_LABEL = "neutral"


def label_modes(df: DataFrame, key: list[str], label: str) -> DataFrame:
    """One row per group: ``modes``, the sorted array of its most frequent labels (empty if it has none)."""
    counts = df.groupBy(*key, F.col(label).alias("_label")).agg(F.count(label).alias("_n"))
    found = counts.groupBy(*key).agg(F.max("_n").alias("_top"), F.collect_list(F.struct("_n", "_label")).alias("_all"))
    tied = F.filter("_all", lambda x: (x["_n"] == F.col("_top")) & x["_label"].isNotNull())
    return found.select(*key, F.array_sort(F.transform(tied, lambda x: x["_label"])).alias("modes"))


def resolve_ties(modes: Column, rule: dict = TIE_RULE, empty: str = EMPTY_LABEL) -> Column:
    """The single mode, or what the rule says of a tie; a tie the rule lacks goes to the first label."""
    expr = F.when(F.size(modes) == 0, F.lit(empty))
    for combo, out in rule.items():
        expr = expr.when(modes == F.array(*[F.lit(v) for v in combo]), F.lit(out))
    return expr.otherwise(F.get(modes, F.lit(0)))


def group_mode(df: DataFrame, key: list[str], label: str, out: str = "mode",
               keep_set: bool = False) -> DataFrame:
    """One row per group with the tie-resolved most frequent label."""
    res = label_modes(df, key, label).withColumn(out, resolve_ties(F.col("modes")))
    return res.select(*key, out, *(["modes"] if keep_set else []))
