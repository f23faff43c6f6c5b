"""Operator 7 against brute force over all pairs."""

import itertools
import random

import numpy as np
import pytest
import xxhash

from finlake.llm import simhash
from finlake.llm.components import components

from .data import PROSE, SMALL, awkward, awkward_rows, empty


def slow_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids_fps, radius=4):
    root = list(range(len(ids_fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    fps = np.array([f for _, f in ids_fps], np.uint64)
    for i in range(len(fps)):
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= radius)
        for j in near.tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(ids_fps):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [least.get(find(i)) for i in range(len(ids_fps))]


def check(docs, rows):
    fps = [(d, slow_fingerprint(t)) for d, t in rows]
    want = sorted((str(d), f"{f:016x}", str(c)) for (d, f), c in zip(fps, slow_components(fps)))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    assert got == want


def test_driver_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    check(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_awkward_rows_equal_brute_force(spark):
    check(awkward(spark), [(r[0], r[1]) for r in awkward_rows()])
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_spark_hash_is_the_contract_hash(spark):
    from pyspark.sql import functions as F

    got = spark.range(1).select(F.xxhash64(F.lit("a b c dé"))).first()[0]
    assert got % 2**64 == xxhash.xxh64("a b c dé".encode(), seed=42).intdigest()


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    m = [x % 2**64 for x in simhash.masks(radius)]
    assert len(m) == 2 ** (radius + 1) - 1
    r = random.Random(radius)
    sets = itertools.combinations(range(64), radius) if radius < 3 else (r.sample(range(64), radius) for _ in range(5000))
    for s in sets:
        differ = sum(1 << b for b in s)
        assert any(differ & x == 0 for x in m)


def test_dense_buckets_find_chains_between_components(spark):
    """Many fingerprints in the same buckets: chains of close ones, stars, and strangers that share masks."""
    r = random.Random(5)
    fps = set()
    for _ in range(40):
        f = r.getrandbits(64)
        for _ in range(25):
            fps.add(f)
            for b in r.sample(range(12), r.randint(1, 4)):  # all changes in a few bits: crowded buckets
                f ^= 1 << b
    fps = sorted(fps)
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    label = {x.fp: x.label for x in simhash.fingerprint_components(df, 4).collect()}
    want = slow_components(list(zip(range(len(fps)), fps)))
    got = {}
    for i, f in enumerate(signed):
        got.setdefault(label.get(f, f), i)
    assert [got[label.get(f, f)] for f in signed] == want


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(500, 600 + i) for i in range(50)] + [(7, 7), (9, 8), (8, 9)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert {got[i] for i in range(100, 141)} == {100}
    assert {got[600 + i] for i in range(50)} == {500} and got[500] == 500 and got[9] == 8 and 7 not in got


def test_representatives_keep_one_row_per_group(spark):
    rows = [(3, PROSE, "x"), (2, PROSE, "y"), (2, PROSE, "z"), (None, PROSE, "w"), (9, "quite other words here now", "v")]
    kept = simhash.representatives(spark.createDataFrame(rows, "doc_id long, text string, _t string")).collect()
    assert sorted(r.doc_id for r in kept) == [2, 9] and set(kept[0].asDict()) == {"doc_id", "text", "_t"}


def test_further_masks_miss_no_pair():
    r = random.Random(1)
    for t, (mask, parts) in enumerate(zip(simhash.masks(4), simhash.part_masks(4))):
        rest = [i for i in range(64) if not mask >> i & 1]
        assert len(parts) == 70 and all(p & mask == 0 for p in parts)
        for _ in range(20):
            flipped = sum(1 << i for i in r.sample(rest, r.randint(0, 4)))
            assert any(p & flipped == 0 for p in parts)


@pytest.mark.parametrize("pairs", [0, simhash.PAIRS])
def test_buckets_without_a_main_component(spark, monkeypatch, pairs):
    """Fingerprints that share a mask's bits and differ in many others, a few of them near each other."""
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    r = random.Random(8)
    mask = simhash.masks(4)[3] & (1 << 64) - 1
    shared = r.getrandbits(64) & mask
    fps = [shared | r.getrandbits(64) & ~mask & (1 << 64) - 1 for _ in range(400)]
    for k in range(40):
        near = fps[k]
        for i in r.sample([i for i in range(64) if not mask >> i & 1], r.randint(1, 4)):
            near ^= 1 << i
        fps.append(near)
    fps = list(dict.fromkeys(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    label = {x.fp: x.label for x in simhash.fingerprint_components(
        spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    groups = {}
    for f in signed:
        groups.setdefault(label.get(f, f), set()).add(f)
    want = {}
    for f, c in zip(signed, slow_components(list(enumerate(fps)))):
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert max(map(len, groups.values())) >= 2
