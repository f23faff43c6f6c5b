"""Operator 12: exact deduplication with a heavy-hitter split.

Texts are equal when their UTF-8 bytes are (null counts as empty); a text's
digest is its SHA-256.  Of equal texts the row with the largest id stays.

* **Misra-Gries.**  Each task keeps ``counters`` counters over the digests of
  its rows; a full summary subtracts its (counters + 1)-th largest count from
  all.  A task so undercounts a digest by at most 1 / (counters + 1) of its
  rows.  The summaries are added up by digest (an ordinary grouped sum, no
  single merging task), with a total error E of at most N / (counters + 1).
* **Verified winners.**  A digest of ``T = 2 N / (counters + 1)`` rows or more
  has a sum above T - E, and fewer than ``counters + 1`` digests have that, so
  the candidates are bounded whatever the data.  One more pass counts them
  exactly and finds each one's winner.
* **Map side.**  The verified winners (at most ``counters`` rows of under 100
  bytes) are broadcast; rows of frequent digests are settled where they are
  read.  All others meet by an ordinary shuffle on the digest, in groups
  smaller than T.

Only digests, ids and row hashes are shuffled for the verdicts; ``dedup`` then
joins whole rows with the winners once.

Defined cases: null ids rank below all others (a null id stays only among null
ids); rows that repeat an id and its text are ranked by a hash of their other
columns, and exactly one of them stays; an empty table gives no rows; extra
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.store import ship, stored

COUNTERS = 4096


class Summary:
    """Misra-Gries summary of a stream of digests, merged batch by batch."""

    def __init__(self, counters: int):
        self.counters, self.lost = counters, 0
        self.keys, self.counts = pa.array([], pa.binary()), np.zeros(0, np.int64)

    def add(self, digests: pa.Array) -> None:
        keys = pa.concat_arrays([self.keys, digests.cast(pa.binary())])
        weight = pa.array(np.concatenate([self.counts, np.ones(len(digests), np.int64)]))
        sums = pa.table({"k": keys, "n": weight}).group_by("k").aggregate([("n", "sum")])
        self.keys, self.counts = sums["k"].combine_chunks(), sums["n_sum"].to_numpy()
        if len(self.counts) > self.counters:
            cut = int(np.partition(self.counts, -self.counters - 1)[-self.counters - 1])
            stay = self.counts > cut
            self.keys, self.counts = self.keys.filter(pa.array(stay)), self.counts[stay] - cut
            self.lost += cut


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` as ``row`` with ``doc_id``, ``digest`` (32 bytes) and ``other``, a hash of the remaining columns."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    other = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]))) if rest \
        else F.lit(0).cast("long")
    return docs.select("doc_id", F.unhex(F.sha2(_text(), 256)).alias("digest"), other.alias("other"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def frequent(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests that may have ``2 N / (counters + 1)`` rows; all that do, and at most ``counters``."""
    ship(rows.sparkSession)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Summary(counters)
        n = 0
        for b in batches:
            n += b.num_rows
            s.add(b.column("digest"))
        size = len(s.counts)
        # the last row holds the task's rows and its error
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([s.keys, pa.array([None], pa.binary())]), pa.array([*s.counts.tolist(), 0], pa.int64()),
             pa.array([0] * size + [n], pa.int64()), pa.array([0] * size + [s.lost], pa.int64())],
            names=["digest", "n", "n_rows", "lost"])

    made = stored(rows.select("digest").mapInArrow(summarise, "digest binary, n long, n_rows long, lost long"),
                  "misra-gries")
    total, lost = made.agg(F.coalesce(F.sum("n_rows"), F.lit(0)), F.coalesce(F.sum("lost"), F.lit(0))).first()
    least = max(2.0, 2 * total / (counters + 1))
    return made.filter("digest is not null").groupBy("digest").agg(F.sum("n").alias("n")).filter(
        F.col("n") > least - lost - 0.5).select("digest")


def _rank() -> Column:
    """Larger stays: null ids last, then the hash of the other columns, then the row's place."""
    return F.struct(F.col("doc_id").isNotNull().alias("has"), F.col("doc_id"), F.col("other"), F.col("at"))


def verdicts(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``doc_id, digest, other, keep_id, keep_other, group_size, kept``, one row for each of ``rows``."""
    rows = stored(rows.select("doc_id", "digest", "other").withColumn("at", F.monotonically_increasing_id()), "digests")
    exact = rows.join(F.broadcast(frequent(rows, counters)), "digest").groupBy("digest").agg(
        F.max(_rank()).alias("best"), F.count(F.lit(1)).alias("group_size"))
    heavy = F.broadcast(stored(exact, "winners"))
    settled = rows.join(heavy, "digest")
    group = Window.partitionBy("digest")
    light = rows.join(heavy, "digest", "left_anti").withColumn("best", F.max(_rank()).over(group)).withColumn(
        "group_size", F.count(F.lit(1)).over(group))
    return settled.unionByName(light).select(
        "doc_id", "digest", "other", F.col("best.doc_id").alias("keep_id"), F.col("best.other").alias("keep_other"),
        "group_size", (F.col("at") == F.col("best.at")).alias("kept"))


def digest_rows(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: what stays of its group, the group's size, whether it is the one, its digest."""
    return verdicts(keyed(docs), counters).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def dedup(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The whole rows that stay, with the columns of ``docs``: one of each text."""
    rows = keyed(docs)
    best = verdicts(rows, counters).filter("kept").select("digest", "doc_id", "other")
    on = (rows["digest"] == best["digest"]) & rows["doc_id"].eqNullSafe(best["doc_id"]) & (rows["other"] == best["other"])
    # rows alike in every column match together; any one of them is the row
    same = rows.join(best, on, "left_semi").groupBy("digest").agg(F.any_value("row").alias("row"))
    return same.select("row.*")
