"""A random forest on the window features, grown by grouped histograms in the JVM.

A window of ``seq_len`` rows and its next close become one row: the last row's
prices and sentiment and a few earlier closes (all by bounded lags inside
blocks, so no window is ever copied out).  Features fall into ``BINS`` equal
bins of the scaled range, targets are kept in millionths.

* Rows are written once; every level is one grouped count and sum over (tree,
  node, feature, bin), at most ``TREES * 2^DEPTH * features * BINS`` groups
  however many rows there are, added up before anything is shuffled.
* A tree learns from the rows whose hash has a digit of ten at its place, and
  splits on two thirds of the features.  A split is the one that leaves the
  least squared error (ties: first feature, then first bin); sums are of
  integers, so they are exact in any order and the forest is always the same.
* The driver holds the trees alone.  A tree becomes nested ``when`` expressions,
  so growing, and scoring all rows, stay in generated code.

Defined cases: rows without a complete window are not used; a node under
``2 * LEAST_ROWS`` rows, or that no bin splits, is a leaf; without training rows
there is no forest and no result; companies without test rows have no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.functions.scalar import rounded
from finlake.operators.scaling import unscaled
from finlake.operators.series import lagged
from finlake.session import cut_lineage

KEY = ["Ticker"]
TREES, DEPTH, BINS, LEAST_ROWS = 8, 4, 32, 10
UNIT = 1_000_000
#: feature -> (column, rows before the target)
FEATURES = (("close1", "Close", 1), ("high1", "High", 1), ("low1", "Low", 1), ("open1", "Open", 1), ("close6", "Close", 6),
            ("close11", "Close", 11), ("close26", "Close", 26), ("close50", "Close", 50), ("mood", "Sentiment", 1))
MOODS = {"negative": 0, "neutral": 1}

Split = tuple[int, int]
Tree = dict[int, Split]


def used(tree: int, feature: int) -> bool:
    """Whether a tree may split on a feature."""
    return (7 * tree + 5 * feature) % 3 != 0


def window_rows(scaled: DataFrame, seq_len: int = 50) -> DataFrame:
    """One row per window: its features' bins, the target in millionths, the trees it is for."""
    if seq_len < max(n for *_, n in FEATURES):
        raise ValueError("a window holds all rows that the features look at")
    rows = lagged(scaled, [*KEY, "split"], "split_rn", {name: (col, n) for name, col, n in FEATURES})
    rows = rows.filter(F.col("split_rn") > seq_len)
    bins = []
    for name, col, _ in FEATURES:
        if col == "Sentiment":
            bins.append(F.coalesce(*[F.when(F.col(name) == m, k) for m, k in MOODS.items()], F.lit(2)).alias(name))
        else:
            bins.append(F.least(F.greatest(F.floor(F.col(name) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int").alias(name))
    digits = F.md5(F.concat_ws("|", "Ticker", F.col("Date").cast("string")).cast("binary"))
    return rows.select(*KEY, "split", F.round(F.col("Close") * UNIT).cast("bigint").alias("y"), digits.alias("h"), *bins)


def node_of(tree: Tree, node: int = 1) -> Column:
    """The node that a row comes to, numbered as in a heap."""
    if node not in tree:
        return F.lit(node)
    feature, bound = tree[node]
    return F.when(F.col(FEATURES[feature][0]) > bound, node_of(tree, 2 * node + 1)).otherwise(node_of(tree, 2 * node))


def _nodes(rows: DataFrame, forest: list[Tree]) -> DataFrame:
    """The training rows with their node in each tree (``n0``, ``n1``, ...); null in a tree that doesn't have them."""
    return rows.select("y", *[n for n, *_ in FEATURES], *[
        F.when(F.substring("h", t + 1, 1) < "a", node_of(tree)).alias(f"n{t}") for t, tree in enumerate(forest)])


def next_splits(rows: DataFrame, forest: list[Tree], level: int) -> list[tuple[int, int, int, int]]:
    """(tree, node, feature, bound) of the nodes of a level that are split."""
    cells = _nodes(rows, forest).select("y", F.inline(F.array(*[
        F.struct(F.lit(t).alias("tree"), F.col(f"n{t}").alias("node"), F.lit(f).alias("f"), F.col(name).alias("b"))
        for t in range(len(forest)) for f, (name, *_) in enumerate(FEATURES) if used(t, f)])))
    cells = cells.filter(F.col("node") >= 2**level)
    sums = cells.groupBy("tree", "node", "f", "b").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))
    # at most BINS rows in a group
    upto = Window.partitionBy("tree", "node", "f").orderBy("b")
    whole = Window.partitionBy("tree", "node", "f")
    cut = sums.withColumns({"nl": F.sum("n").over(upto), "sl": F.sum("s").over(upto), "na": F.sum("n").over(whole),
                            "sa": F.sum("s").over(whole)})
    d = lambda c: F.col(c).cast("double")
    right_n, right_s = (F.col("na") - F.col("nl")).cast("double"), (F.col("sa") - F.col("sl")).cast("double")
    cut = cut.filter((F.col("nl") >= LEAST_ROWS) & (F.col("na") - F.col("nl") >= LEAST_ROWS)).withColumn(
        "gain", d("sl") * d("sl") / d("nl") + right_s * right_s / right_n)
    best = cut.groupBy("tree", "node").agg(F.max(F.struct(
        "gain", (-F.col("f")).alias("f"), (-F.col("b")).alias("b"))).alias("m"))
    return [(r["tree"], r["node"], -r["m"]["f"], -r["m"]["b"]) for r in best.collect()]


def grow(rows: DataFrame, trees: int = TREES, depth: int = DEPTH) -> list[tuple[Tree, dict[int, int]]]:
    """Trees and their leaves' values, from stored training rows."""
    forest: list[Tree] = [{} for _ in range(trees)]
    for level in range(depth):
        for tree, node, feature, bound in next_splits(rows, forest, level):
            forest[tree][node] = (feature, bound)
    leaves: list[dict[int, int]] = [{} for _ in range(trees)]
    means = _nodes(rows, forest).select("y", F.inline(F.array(*[
        F.struct(F.lit(t).alias("tree"), F.col(f"n{t}").alias("node")) for t in range(trees)]))).filter(
        "node is not null").groupBy("tree", "node").agg(
        F.round(F.sum("y").cast("double") / F.count(F.lit(1))).cast("bigint").alias("v"))
    for r in means.collect():
        leaves[r["tree"]][r["node"]] = r["v"]
    return [(t, v) for t, v in zip(forest, leaves) if v]


def prediction(forest: list[tuple[Tree, dict[int, int]]]) -> Column:
    """The trees' mean as an expression over a row's bins."""
    def value(tree: Tree, leaves: dict[int, int], node: int = 1) -> Column:
        if node not in tree:
            return F.lit(leaves[node])
        feature, bound = tree[node]
        return F.when(F.col(FEATURES[feature][0]) > bound, value(tree, leaves, 2 * node + 1)).otherwise(
            value(tree, leaves, 2 * node))

    total = F.lit(0).cast("bigint")
    for tree, leaves in forest:
        total = total + value(tree, leaves)
    return total.cast("double") / (len(forest) * UNIT)


def random_forest(scaled: DataFrame, params: DataFrame, seq_len: int = 50, trees: int = TREES,
                  depth: int = DEPTH) -> DataFrame:
    """Fit on the train windows of all companies; test error per company in price units."""
    rows = cut_lineage(window_rows(scaled, seq_len))
    forest = grow(rows.filter(F.col("split") == "train").drop("split"), trees, depth)
    test = rows.filter(F.col("split") == "test")
    if not forest:
        test, forest = test.filter(F.lit(False)), [({}, {1: 0})]
    scored = test.withColumn("_p", prediction(forest)).join(params, KEY)
    err = unscaled(F.col("_p"), "Close") - unscaled(F.col("y").cast("double") / UNIT, "Close")
    out = scored.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_test"), F.avg(err * err).alias("_mse"))
    return out.select(*KEY, "n_test", rounded(F.col("_mse"), 3).alias("mse"), rounded(F.sqrt("_mse"), 4).alias("rmse"))
