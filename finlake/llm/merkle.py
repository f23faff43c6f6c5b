"""Operator 13: Merkle manifest of a table by butterfly exchange.

``H`` is the lowercase hex SHA-256 of its inputs in a row.  Each document is a
leaf; the leaves of a language, by ascending id, are hashed in runs of
``FANOUT`` until one node, the language's subroot, is left; the subroots, by
language, likewise give the root.

* **Aligned partitions.**  Leaves get their place within the language
  (``ordering.numbered``) and are packed into blocks of ``FANOUT ** DEPTH``
  consecutive ones, a row each, however many rows a language has.  A block
  hashes its own subtree.
* **Butterfly.**  In round r the blocks of aligned groups of ``FANOUT ** r``
  share one node, whose digest each of them holds.  Each block sends it to the
  block at the same offset in each of the sibling groups (a ragged last group
  serves the offsets it lacks in turn), gets at most ``FANOUT`` digests, notes
  the siblings as the next step of its proof and hashes the parent itself.
  After log_FANOUT(blocks) rounds every block holds the root and its own upper
  proof: the ancestors are hashed redundantly, and nothing is sent down again.
* The same steps over the subroots, a single group, give the root.
* Each block then makes its leaves' proofs: the steps within the block, those
  of the butterfly, those of its language.

Texts are read and hashed once where they are scanned; what is shuffled per
document are its id and digests, and per block and round ``FANOUT`` digests.

Defined cases: a null field is hashed as ``-``; a null language is a language
of its own and comes first, null ids come first in theirs; documents that
repeat an id are ordered by their digest, and equal rows are leaves of their
own; an empty table has no rows; a document without id is not tampered with;
extra columns are not part of a leaf.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm.ordering import numbered
from finlake.llm.store import ship, stored

FANOUT = 8
#: levels of a block: 4,096 leaves, about half a MB a row
DEPTH = 4

STEP = "array<struct<at: int, others: array<string>>>"


def field(name: str) -> Column:
    """A field as it is hashed: byte count, colon, value; ``-`` for null."""
    value = F.col(name).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(text: Column) -> Column:
    head = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    body = F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*head, body), 256)


def h(parts: list[str]) -> str:
    return sha256("".join(parts).encode("ascii")).hexdigest()


def climb(nodes: list[str], depth: int | None) -> tuple[str, list[list[str]]]:
    """The top of ``depth`` levels (None: until one node is left) over ``nodes``, and all levels below it."""
    levels = []
    while len(nodes) > 1 if depth is None else len(levels) < depth:
        levels.append(nodes)
        nodes = [h(nodes[k:k + FANOUT]) for k in range(0, len(nodes), FANOUT)]
    return nodes[0], levels


def fold(node: str, steps: list[tuple[int, list[str]]]) -> str:
    """The root that ``node`` and its siblings, step by step, give."""
    for at, others in steps:
        node = h([*others[:at], node, *others[at:]])
    return node


def inner_steps(levels: list[list[str]], k: int) -> list[tuple[int, list[str]]]:
    """The steps of leaf ``k`` within its block."""
    out = []
    for nodes in levels:
        run, at = nodes[k - k % FANOUT:k - k % FANOUT + FANOUT], k % FANOUT
        out.append((at, run[:at] + run[at + 1:]))
        k //= FANOUT
    return out


def pack(leaves: DataFrame, order: list[str], keep: list[str], depth: int, name: str) -> DataFrame:
    """Blocks of consecutive leaves of each ``_g``: ``_g, block, n_blocks, rows`` (leaf and ``keep``, in order)."""
    size = FANOUT ** depth
    at = numbered(leaves, order, f"{name}-leaves").withColumn("block", F.floor(F.col("_pos") / size))
    rows = at.groupBy("_g", "block").agg(
        F.array_sort(F.collect_list(F.struct("_pos", "leaf", *keep))).alias("rows"))  # at most 4,096 of them
    last = at.groupBy("_g").agg((F.max("block") + 1).alias("n_blocks"))
    return stored(rows.join(last, "_g"), f"{name}-blocks")


def _own_top(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tops = [climb(b.column("leaves")[i].as_py(), depth if b.column("n_blocks")[i].as_py() > 1 else None)[0]
                    for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [b.column("_g"), b.column("block"), b.column("n_blocks"), pa.array(tops, pa.string())],
                names=["_g", "block", "n_blocks", "top"])
    return run


def butterfly(blocks: DataFrame, depth: int, name: str) -> DataFrame:
    """``_g, block, root, steps``: every block's way from its top to the root of its group."""
    ship(blocks.sparkSession)
    tops = blocks.select("_g", "block", "n_blocks", F.transform("rows", lambda r: r["leaf"]).alias("leaves")).mapInArrow(
        _own_top(depth), blocks.select("_g", "block", "n_blocks", F.lit("").alias("top")).schema)
    state = stored(tops.withColumn("steps", F.expr(f"cast(array() as {STEP})")), f"{name}-tops")
    most = state.agg(F.max("n_blocks")).first()[0] or 1
    span = 1
    while span < most:
        state = _exchange(state, span)
        span *= FANOUT
    return state.select("_g", "block", F.col("top").alias("root"), "steps")


def _exchange(state: DataFrame, span: int) -> DataFrame:
    """One round: ``span`` blocks share a node; afterwards ``span * FANOUT`` do.  Groups with one node left rest."""
    node = F.floor(F.col("block") / span)
    first = node - node % FANOUT  # the run's first node
    here = F.least(F.lit(span).cast("long"), F.col("n_blocks") - node * span)  # blocks that share this node
    places = F.transform(F.sequence(F.lit(0), F.lit(FANOUT - 1)), lambda j: F.struct(
        ((first + j) * span).alias("low"),
        F.least(F.lit(span).cast("long"), F.col("n_blocks") - (first + j) * span).alias("there")))
    places = F.filter(places, lambda p: p["there"] > 0)
    offset = F.col("block") - node * span
    # the block at each offset of a sibling group hears from the same offset here, or, where this group is the
    # shorter one, from the offset's remainder
    to = F.flatten(F.transform(places, lambda p: F.when(offset < p["there"], F.transform(
        F.sequence(offset, p["there"] - 1, here), lambda o: p["low"] + o)).otherwise(F.array().cast("array<bigint>"))))
    moving = F.col("n_blocks") > span
    sent = state.select(
        "_g", "n_blocks", F.col("block").alias("by"), (node % FANOUT).cast("int").alias("j"), "top", "steps",
        F.explode(F.when(moving, to).otherwise(F.array("block"))).alias("block"))
    own = F.col("by") == F.col("block")
    got = sent.groupBy("_g", "block").agg(
        F.max("n_blocks").alias("n_blocks"), F.max(F.when(own, F.col("j"))).alias("at"),
        F.max_by("steps", F.when(own, F.lit(1))).alias("steps"),
        F.array_sort(F.collect_list(F.struct("j", "top"))).alias("run"))  # at most FANOUT of them
    others = F.transform(F.filter("run", lambda r: r["j"] != F.col("at")), lambda r: r["top"])
    step = F.array(F.struct(F.col("at"), others.alias("others")))
    return got.select(
        "_g", "block", "n_blocks",
        F.when(moving, F.sha2(F.array_join(F.transform("run", lambda r: r["top"]), "").cast("binary"), 256)).otherwise(
            F.col("run")[0]["top"]).alias("top"),
        F.when(moving, F.concat("steps", step.cast(STEP))).otherwise(F.col("steps")).alias("steps"))


def _proofs(depth: int, proof: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield _block_proofs({n: b.column(n)[i].as_py() for n in b.schema.names}, depth, proof)
    return run


def _block_proofs(block: dict, depth: int, proof: bool) -> pa.RecordBatch:
    """One row per leaf of a block; ``proof``: with the siblings themselves."""
    rows, upper = block["rows"], [(s["at"], s["others"]) for s in [*block["steps"], *block["lang_steps"]]]
    leaves = [r["leaf"] for r in rows]
    levels = climb(leaves, depth if block["n_blocks"] > 1 else None)[1]
    above = "".join("".join(others) for _, others in upper)
    ways, folded = [], []
    for k, r in enumerate(rows):
        steps = inner_steps(levels, k)
        ways.append("".join("".join(others) for _, others in steps) + above)
        folded.append(fold(r["changed"] or r["leaf"], steps + upper))
    n, root = len(rows), block["root"]
    columns = [pa.array([r["doc_id"] for r in rows], pa.int64()), pa.array(leaves, pa.string()),
               pa.array([block["subroot"]] * n, pa.string()), pa.array([root] * n, pa.string()),
               pa.array([h([w]) for w in ways], pa.string()), pa.array(folded, pa.string()),
               pa.array([f == root for f in folded], pa.bool_())]
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    if proof:
        columns.append(pa.array(ways, pa.string()))
        names.append("proof")
    return pa.RecordBatch.from_arrays(columns, names=names)


def tampered(doc_id: Column) -> Column:
    """The rows whose text the check changes: 3 divides the crc32 of the id's text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def manifest(docs: DataFrame, proof: bool = False, depth: int = DEPTH) -> DataFrame:
    """Per document its leaf, its language's subroot, the root, its proof's digest, and the check of the tampered text.

    ``proof`` adds the proof itself: the siblings' digests in a row, 64 characters each.
    """
    spark: SparkSession = docs.sparkSession
    ship(spark)
    lowered = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("v"), "lang"), F.lit("n")).alias("_g"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf(F.col("text")).alias("leaf"),
        F.when(tampered(F.col("doc_id")), leaf(lowered)).alias("changed"))
    blocks = pack(stored(leaves, "leaves"), ["doc_id", "leaf"], ["doc_id", "changed"], depth, "docs")
    upper = stored(butterfly(blocks, depth, "docs"), "upper")
    subroots = upper.filter("block = 0").select(F.lit("all").alias("_g"), F.col("_g").alias("lang"),
                                                F.col("root").alias("leaf"))
    tops = pack(subroots, ["lang"], ["lang"], depth, "langs")
    way = butterfly(tops, depth, "langs")
    langs = stored(tops.join(way, ["_g", "block"]).mapInArrow(
        _lang_steps(depth), f"_g string, subroot string, root string, lang_steps {STEP}"), "langs")
    whole = blocks.join(upper.select("_g", "block", "steps"), ["_g", "block"]).join(langs, "_g")
    made = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, " \
           "verified boolean" + ", proof string" * proof
    return whole.select("n_blocks", "rows", "steps", "lang_steps", "subroot", "root").mapInArrow(_proofs(depth, proof), made)


def _lang_steps(depth: int):
    """Each language's way from its subroot to the root."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i in range(b.num_rows):
                rows, n = b.column("rows")[i].as_py(), b.column("n_blocks")[i].as_py()
                levels = climb([r["leaf"] for r in rows], depth if n > 1 else None)[1]
                upper = [(s["at"], s["others"]) for s in b.column("steps")[i].as_py()]
                root = b.column("root")[i].as_py()
                out += [(r["lang"], r["leaf"], root, [{"at": at, "others": o} for at, o in inner_steps(levels, k) + upper])
                        for k, r in enumerate(rows)]
            kind = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.list_(pa.string()))]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], pa.string()) for i in range(3)] + [pa.array([x[3] for x in out], kind)],
                names=["_g", "subroot", "root", "lang_steps"])
    return run
