"""Operator 7: SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: 64 bits, each set if more than half of the hashes of the text's
word shingles have it set.  Two fingerprints link at ``radius`` or fewer
differing bits.

Covering tables: bit position i gets a vector m(i) of ``radius + 1`` bits; for
each non-zero vector v there is a table whose mask holds the positions with
odd <m(i), v>.  At most ``radius`` differing positions span fewer than
``radius + 1`` dimensions, so some v is orthogonal to all of them: that table's
mask avoids every differing bit and the pair shares its key.  2^5 - 1 = 31
tables of 32 bits serve radius 4, and no pair is ever missed.

Buckets are never turned into all their pairs.  Equal fingerprints are one
node.  Each member of a bucket is compared with the bucket's smallest and
largest fingerprint (aggregated, not gathered); the links give components.  A
bucket of two or three is then done.  In a larger bucket only members outside
the bucket's main component are compared with the members of other components,
because a link inside a component changes nothing.  That finds every link that
could still join two components, so the components are exact.  Where a bucket
has no main component (texts that share its mask's bits and little else), its
members are put into further buckets by the bits that the mask leaves out: of
eight groups of those bits four differing bits leave four equal, so every pair
within the radius meets for one of the 70 choices of four groups.

Defined cases: null and empty texts (no words) have fingerprint zero and link
like any other; fewer words than a shingle make one shingle of all words; rows
that repeat an id each get a result row; a null id takes part, but a
component's id is its smallest non-null id (null if none); extra columns are
not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.components import components
from finlake.llm.hot import join_by_key
from finlake.llm.store import per_text, row_key, stored

SEED = 42
#: comparisons of a bucket above which its members meet by further bits instead
PAIRS = 20_000
#: shingles hashed at a time, so a very long text needs little memory
CHUNK = 1 << 15


def shingle_hashes(text: str | None, width: int) -> Iterator[np.ndarray]:
    """XXH64 of each shingle, in chunks.

    Words are runs of other than blank, tab, line feed, vertical tab, form
    feed, carriage return; A-Z is lower-cased; shingles repeat as in the text.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    digest = xxhash.xxh64_intdigest
    flat, place, size = b" ".join(words), np.zeros(len(words) + 1, np.int64), len(words)
    np.cumsum([len(w) + 1 for w in words], out=place[1:])
    if size < width:
        yield np.array([digest(flat, SEED)], np.uint64)
        return
    for low in range(0, size - width + 1, CHUNK):
        high = min(low + CHUNK, size - width + 1)
        begin, end = place[low:high].tolist(), (place[low + width:high + width] - 1).tolist()
        yield np.array([digest(flat[i:j], SEED) for i, j in zip(begin, end)], np.uint64)


def fingerprint(text: str | None, width: int = 4) -> int:
    ones, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text, width):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def _with_fingerprint(df: DataFrame, width: int) -> DataFrame:
    """``df`` with ``fp``, the text's fingerprint as a signed 64-bit number, in place of the text."""
    def run(texts):
        return [np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)]

    return per_text(df, run, "fp long")


def representatives(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row per component: the smallest id (then text hash); null ids come last."""
    keyed = docs.select(*row_key(F.col("doc_id"), F.col("text")), F.struct("*").alias("row"))
    fps = stored(_with_fingerprint(keyed.select("_d", "_t", F.col("row.text").alias("text")), width), "fingerprints")
    label = fingerprint_components(fps, radius)
    first = F.min(F.struct("_d", "_t")).alias("k")
    of_fp = fps.groupBy("fp").agg(first).join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    kept = of_fp.groupBy("label").agg(F.min("k").alias("k")).select("k._d", "k._t")
    out = keyed.join(kept, ["_d", "_t"], "left_semi")
    if fps.groupBy("_d", "_t").count().filter("count > 1").limit(1).count():  # rows that are the same twice
        out = out.dropDuplicates(["_d", "_t"])
    return out.select("row.*")


def masks(radius: int, seed: int = 5) -> list[int]:
    """Signed 64-bit masks of the covering tables.

    The 64 positions take the vectors in turn (shuffled once), so each mask
    holds about half the positions.
    """
    dims = radius + 1
    vectors = np.random.default_rng(seed).permutation(64) % (1 << dims)
    out = []
    for v in range(1, 1 << dims):
        bits = sum(1 << i for i, m in enumerate(vectors.tolist()) if bin(m & v).count("1") % 2)
        out.append(bits - (1 << 64) if bits >> 63 else bits)
    return out


def _near(a: str, b: str, radius: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius


def part_masks(radius: int) -> list[list[int]]:
    """Per table, signed masks over the bits that its own mask leaves out.

    Those bits are dealt to ``2 * radius`` groups; up to ``radius`` differing
    bits leave as many groups untouched, so some choice of ``radius`` groups is
    equal in both.
    """
    out = []
    for mask in masks(radius):
        rest = [i for i in range(64) if not mask >> i & 1]
        groups = [sum(1 << i for i in rest[k::2 * radius]) for k in range(2 * radius)]
        chosen = [sum(c) for c in combinations(groups, radius)]
        out.append([m - (1 << 64) if m >> 63 else m for m in chosen])
    return out


def _links(rows: DataFrame, bucket: list[str], radius: int) -> DataFrame:
    """Components that a member outside its bucket's main component links."""
    few = rows.filter("c != main").select(*bucket, F.col("fp").alias("fp2"), F.col("c").alias("c2"))
    return few.join(rows.select(*bucket, "fp", "c"), bucket).filter("c != c2").filter(
        _near("fp", "fp2", radius)).select("c", "c2")


def fingerprint_components(fps: DataFrame, radius: int = 4) -> DataFrame:
    """``fp, label`` for the distinct fingerprints that link to another one."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(m).alias("m")) for t, m in enumerate(masks(radius))])
    keyed = fps.select("fp").distinct().select("fp", F.explode(tables).alias("x")).select(
        F.col("x.t").cast("byte").alias("t"), F.col("fp").bitwiseAND(F.col("x.m")).alias("key"), "fp")
    buckets = keyed.groupBy("t", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high")).filter("n > 1")
    shared = stored(keyed.join(buckets, ["t", "key"]), "shared")
    links = stored(shared.filter("fp != low").filter(_near("fp", "low", radius)).select("fp", F.col("low").alias("to"))
                   .union(shared.filter("fp != high and low != high").filter(_near("fp", "high", radius))
                          .select("fp", F.col("high").alias("to"))).distinct(), "star")
    label = components(links, "fp", "to")
    # what the stars can't settle: buckets of four or more that hold several components
    large = shared.filter("n > 3").select("t", "key", "fp").join(
        label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("c", F.coalesce("label", "fp"))
    sizes = large.groupBy("t", "key", "c").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("t", "key").agg(F.max(F.struct("k", "c")).alias("top"), F.count(F.lit(1)).alias("parts"))
    large = stored(large.join(main.filter("parts > 1"), ["t", "key"]).select(
        "t", "key", "fp", "c", F.col("top.c").alias("main")), "large")
    work = large.groupBy("t", "key").agg((F.count(F.lit(1)) * F.count_if(F.col("c") != F.col("main"))).alias("pairs"))
    large = stored(large.join(work, ["t", "key"]), "large-work")
    parts = F.array(*[F.array(*[F.lit(m) for m in every]) for every in part_masks(radius)])
    wide = large.filter(F.col("pairs") > PAIRS).select("*", F.posexplode(F.get(parts, F.col("t").cast("int"))).alias(
        "part", "m")).withColumn("sub", F.col("fp").bitwiseAND(F.col("m")))
    more = stored(_links(large.filter(F.col("pairs") <= PAIRS), ["t", "key"], radius).union(
        _links(wide, ["t", "key", "part", "sub"], radius)).distinct(), "more")
    second = components(more, "c", "c2")
    return label.alias("a").join(second.alias("b"), F.col("a.label") == F.col("b.node"), "left").select(
        F.col("a.node").alias("fp"), F.coalesce("b.label", "a.label").alias("label")).union(
        # single fingerprints that only the second pass linked
        second.join(label.select("node"), "node", "left_anti").select(F.col("node").alias("fp"), "label"))


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits), ``component_id`` (smallest id reached) per document."""
    fps = stored(_with_fingerprint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), width),
                 "fingerprints")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).join(
        fingerprint_components(fps, radius), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    classes = stored(classes, "classes")
    least = classes.groupBy("label").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("k"))
    # a component may hold most fingerprints, and a fingerprint most documents
    ids = stored(join_by_key(classes, least, "label", "k").select("fp", "n", "component_id"), "ids")
    return join_by_key(fps, ids, "fp", "n").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
