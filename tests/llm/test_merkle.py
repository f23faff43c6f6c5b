"""Operator 13 against a Merkle tree built in plain Python."""

import hashlib
import zlib
from collections import Counter

import pytest

from finlake.llm import merkle as M

from .data import SMALL, awkward, awkward_rows, empty

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def one(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return sha("".join(one(v) for v in (*r[:4], text)))


def tree(nodes):
    """(root, [sibling lists per node])"""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            low = k - k % 8
            run = nodes[low:low + 8]
            ways[i].append((k - low, run[:k - low] + run[k - low + 1:]))
            at[i] = k // 8
        nodes = [sha("".join(nodes[k:k + 8])) for k in range(0, len(nodes), 8)]
    return nodes[0], ways


def slow(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> Counter of result rows"""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    per = {}
    for g in langs:
        own = sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        per[g] = (own, *tree([leaf(r, r[4]) for r in own]))
    if not langs:
        return Counter()
    root, tops = tree([per[g][1] for g in langs])
    out = Counter()
    for g, top in zip(langs, tops):
        own, sub, ways = per[g]
        for r, way in zip(own, ways):
            steps = way + top
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(r, text)
            for at, others in steps:
                node = sha("".join([*others[:at], node, *others[at:]]))
            out[(r[0], leaf(r, r[4]), sub, root, sha("".join("".join(o) for _, o in steps)), node, node == root)] += 1
    return out


def result(df):
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
                   for r in df.collect())


@pytest.mark.parametrize("depth", [1, 2, M.DEPTH])
def test_awkward_rows(spark, depth):
    docs = awkward(spark).withColumnRenamed("_d", "n_chars").selectExpr("*", "1 as block", "'x' as leaf")
    rows = [(d, s, g, 7, t) for d, t, g, s in awkward_rows()]
    assert result(M.manifest(docs, depth=depth)) == slow(rows)


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65, 513, 700])
def test_ragged_sizes_with_several_rounds(spark, n):
    """Blocks of eight leaves: up to three rounds, with full and ragged last groups."""
    rows = [(i, "s", "en" if i < n else f"l{i % 11}", i, f"Text {i}") for i in range(n + 20)]
    assert result(M.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5), depth=1)) == slow(rows)


def test_many_languages(spark):
    rows = [(i, None, None if i % 90 == 0 else f"é{i % 90}", None, "A b") for i in range(200)]
    assert result(M.manifest(spark.createDataFrame(rows, SCHEMA), depth=1)) == slow(rows)


def test_a_third_of_the_rows_are_one_row(spark):
    rows = [(None, "s", "en", 1, "Same") if i % 3 == 0 else (i, "s", "en", 1, "Same") for i in range(600)]
    assert result(M.manifest(spark.createDataFrame(rows, SCHEMA).repartition(4), depth=2)) == slow(rows)


def test_driver_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert result(M.manifest(docs)) == slow(rows)


def test_empty_table(spark):
    assert M.manifest(empty(spark).selectExpr("*", "1L as n_chars")).count() == 0


def test_the_proof_itself_verifies(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, f"t{i}") for i in range(30)], SCHEMA)
    for r in M.manifest(docs, proof=True).collect():
        assert sha(r.proof) == r.proof_sha256 and len(r.proof) % 64 == 0
