"""A headline scorer that is trained: multinomial naive Bayes on hashed TF-IDF, fitted and applied in the JVM.

* Words (runs of letters, lower-cased) fall into ``buckets`` by their MD5.
* Fit: two grouped counts with map-side aggregation, the words of each label
  and the headlines of each bucket; a hot word or label costs a counter.  A
  bucket's weight for a label is idf * ln((tf * idf + 1) / (label's sum + V)), V
  the buckets seen.  idf and logarithm are kept to four decimals as integers,
  so all sums are exact and come out alike in any order.
* The weights are a table of at most ``buckets`` rows.
* Scoring: each word meets its bucket's weights by a broadcast join (bounded by
  ``buckets``) and is added up by headline before anything is shuffled, so what
  moves is one row of sums per headline, however long the texts.

Defined cases: null and empty texts and texts without a known word get the most
frequent label (the prior); rows with a null label aren't learned from; ties go
to the label first in order; with no labelled row every label is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.session import cut_lineage

BUCKETS = 1 << 16
#: four decimals
UNIT = 10_000


def word_buckets(text: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of each word of the text."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))
    return F.transform(words, lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % buckets).cast("int"))


def _fixed(x: Column) -> Column:
    return F.round(x * UNIT).cast("bigint")


def fit(labelled: DataFrame, text: str = "title", label: str = "sentiment", buckets: int = BUCKETS) -> DataFrame:
    """``label, prior, bucket, weight``: a row per label and bucket."""
    return _fit(cut_lineage(labelled.select(F.col(label).alias("label"), word_buckets(F.col(text), buckets).alias(
        "_words"))), buckets)


def _fit(rows: DataFrame, buckets: int) -> DataFrame:
    """The model of stored rows of ``label, _words``."""
    rows = rows.filter(F.col("label").isNotNull())
    labels = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    tf = rows.select("label", F.explode("_words").alias("bucket")).groupBy("label", "bucket").agg(
        F.count(F.lit(1)).alias("tf"))
    df = rows.select(F.explode(F.array_distinct("_words")).alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("df"))
    n = labels.agg(F.sum("n")).scalar()
    idf = df.select("bucket", _fixed(F.log((n + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    idf = cut_lineage(idf)
    sums = cut_lineage(tf.join(idf, "bucket").select("label", "bucket", (F.col("tf") * F.col("idf")).alias("s")))
    seen = idf.agg(F.count(F.lit(1))).scalar()
    total = labels.join(sums.groupBy("label").agg(F.sum("s").alias("total")), "label", "left")
    # labels are few: a row for each of them and each bucket; one that a label never saw has the weight of a zero
    cells = total.select("label", _fixed(F.log(F.col("n") / n)).alias("prior"), F.coalesce("total", F.lit(0)).alias("total"),
                         F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    log = _fixed(F.log((F.coalesce("s", F.lit(0)) + UNIT) / (F.col("total") + seen * UNIT)))
    return cells.join(sums, ["label", "bucket"], "left").join(idf, "bucket", "left").select(
        "label", "prior", "bucket", F.coalesce(F.col("idf") * log, F.lit(0)).alias("weight"))


def score(df: DataFrame, model: DataFrame, text: str = "title", out: str = "sentiment", margin: str = "margin",
          buckets: int = BUCKETS) -> DataFrame:
    """``df`` with the most likely label and by how much it leads the next one (in natural logarithms)."""
    rows = cut_lineage(df.withColumns({"_row": F.monotonically_increasing_id(),
                                       "_words": word_buckets(F.col(text), buckets)}))
    return _score(rows, model, df.columns, out, margin)


def _score(rows: DataFrame, model: DataFrame, columns: list[str], out: str, margin: str) -> DataFrame:
    """Scores of stored rows with ``_row`` and ``_words``."""
    # one row per label: the classes that the model knows
    labels = sorted((r.label, r.prior) for r in model.filter("bucket = 0").select("label", "prior").collect())
    if not labels:
        return rows.select(*columns, F.lit(None).cast("string").alias(out), F.lit(None).cast("double").alias(margin))
    each = [f"_s{i}" for i in range(len(labels))]
    table = model.groupBy("bucket").agg(*[
        F.sum(F.when(F.col("label") == name, F.col("weight"))).alias(c) for c, (name, _) in zip(each, labels)])
    # bounded by the number of buckets; a headline's words meet in the task that has them
    words = rows.select("_row", F.explode("_words").alias("bucket"))
    sums = words.join(F.broadcast(table), "bucket").groupBy("_row").agg(*[F.sum(c).alias(c) for c in each])
    total = [F.struct((F.coalesce(c, F.lit(0)) + prior * UNIT).alias("x"), F.lit(-i).alias("i"))
             for i, (c, (_, prior)) in enumerate(zip(each, labels))]
    ranked = rows.join(sums, "_row", "left").withColumn("_best", F.sort_array(F.array(*total), asc=False))
    names = F.array(*[F.lit(name) for name, _ in labels])
    lead = (F.col("_best")[0]["x"] - F.try_element_at("_best", F.lit(2))["x"]) / float(UNIT * UNIT)
    return ranked.select(*columns, names[-F.col("_best")[0]["i"]].alias(out), lead.alias(margin))


def held_out(key: Column) -> Column:
    """Three sixteenths of the rows, by the MD5 of their key."""
    return F.substring(F.md5(key.cast("string")), 1, 1).isin("0", "1", "2")


def scored_headlines(news: DataFrame, key: str = "doc_id", text: str = "title", label: str = "sentiment",
                     buckets: int = BUCKETS) -> DataFrame:
    """Every headline with the label that a model of the rows outside the held-out fold gives it."""
    rows = cut_lineage(news.select(key, "date", "symbol", F.col(label).alias("label"), held_out(F.col(key)).alias("held_out"),
                                   word_buckets(F.col(text), buckets).alias("_words")).withColumn(
        "_row", F.monotonically_increasing_id()))  # the words are made once, for the fit and the scores
    model = _fit(rows.filter(~F.coalesce("held_out", F.lit(False))), buckets)
    return _score(rows, cut_lineage(model), [key, "date", "symbol", "label", "held_out"], "sentiment", "margin")


def confusion(scored: DataFrame) -> DataFrame:
    """Rows by fold, given label and predicted label."""
    return scored.groupBy("held_out", "label", "sentiment").agg(F.count(F.lit(1)).alias("n"))
