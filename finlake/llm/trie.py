"""Operator 11: prefix trie of conversations by burst tries.

Conversations are sequences of turns (role, text); each distinct prefix is a
node.  A turn is known by a 128-bit digest of role and text, salted with its
depth; a prefix by the exclusive or of its turns' digests, so a prefix's id
needs no chain of steps.

* **Suffix containers under trie heads.**  A sequence is cut into segments of
  ``SEGMENT`` turns; segment k stands under the head that the first
  k * SEGMENT turns lead to, so a conversation of any length is many small
  rows.  Equal suffixes under a head are one row with its members' number and
  smallest id: copies cost nothing further.
* **Bursting.**  A container of over ``CONTAINER`` turns becomes trie nodes:
  those of the prefix that all its suffixes share, then one new head for each
  next turn id.  This is repeated until no container is oversized.
* **Sweep.**  The containers left are dealt to tasks by head and sorted by turn
  ids; one sweep over the sorted suffixes with a stack of open nodes makes
  their nodes.
* **Totals.**  A head's totals over its subtree come by pointer doubling over
  the heads alone (log of their depth in rounds); a segment's nodes get the
  totals of the heads that their suffixes lead on to.
* **Members that end at a node** are hashed in the sweep if there is one; longer
  lists are sorted by range, joined to chunks where they lie, and only the
  chunks are hashed in a row.

Texts are read once, for their digests and lengths.

Defined cases: rows without conversation id belong to none and are left out;
null turns come first; rows of equal turn are ordered by role, then by the
digest of their text, and equal rows are turns of their own; null roles and
texts are empty; no conversations: no nodes; extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.ordering import numbered
from finlake.llm.store import ship, stored

#: turns of a sequence in one row
SEGMENT = 256
#: turns (and a suffix each) in a container that is swept; more than a segment
CONTAINER = 1024
#: heads that are sent to every task at most (24 bytes each); more are joined by a shuffle
SMALL = 100_000
#: ids joined to one chunk of a member list
CHUNK = 4096

HEAD = ["hi", "lo"]
NOTHING = sha256(b"").hexdigest()


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it is measured to be small."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first one of its hundred."""
    return (F.crc32(conv.cast("string").cast("binary")) % 6).cast("int")


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv, pos, t, n``: each turn's place, digest of role and text, code points of the text."""
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("_g"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("_g", "turn", "role", F.unhex(F.md5("text")).alias("m"),
                       F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))).alias("t"),
                       F.char_length("text").alias("n"))
    # stored, because dealing to ranges reads its input twice
    return numbered(stored(rows, "turn-digests"), ["turn", "role", "m"], "turns").select(
        F.col("_g").alias("conv"), F.col("_pos").alias("pos"), "t", "n")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (``conv, size``) and their turns (``conv, size, d, t, n``; ``d`` from 1)."""
    most = 5  # the remainder of the hash that gives the shared turns
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    first = turns.filter((F.col("conv") % 100 == 0) & (F.col("pos") < most)).groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "t", "n"))).alias("first"))
    h = shared_turns(F.col("conv"))
    convs = convs.withColumn("base", F.col("conv") - F.col("conv") % 100).join(first, "base", "left").withColumn(
        "first", F.slice(F.coalesce("first", F.array()), F.lit(1), h))
    convs = convs.select("conv", "first", h.alias("h"), F.size("first").cast("long").alias("m"),
                         (F.size("first") + F.greatest(F.lit(0), F.col("own") - h)).alias("size"))
    convs = stored(convs, "conversations")
    own = turns.filter(F.col("pos") >= shared_turns(F.col("conv"))).join(convs.drop("first"), "conv").select(
        "conv", "size", (F.col("m") + F.col("pos") - F.col("h") + 1).alias("d"), "t", "n")
    taken = convs.select("conv", "size", F.posexplode("first")).select(
        "conv", "size", (F.col("pos") + 1).cast("long").alias("d"), "col.t", "col.n")
    return convs.select("conv", "size"), own.unionByName(taken)


def suffixes(convs: DataFrame, turns: DataFrame, segment: int) -> DataFrame:
    """``hi, lo`` (head), ``depth``, ``seq`` (turn ids), ``end_hi, end_lo``, ``more`` (it leads on), ``conv``."""
    ids = turns.select("conv", "size", "d", F.xxhash64("t", "d", F.lit(1)).alias("hi"),
                       F.xxhash64("t", "d", F.lit(2)).alias("lo"), "n",
                       F.floor((F.col("d") - 1) / segment).alias("seg"))
    segs = ids.groupBy("conv", "size", "seg").agg(
        F.array_sort(F.collect_list(F.struct("d", "hi", "lo", "n"))).alias("s"),  # at most a segment's turns
        F.expr("bit_xor(hi)").alias("x_hi"), F.expr("bit_xor(lo)").alias("x_lo"))
    segs = segs.withColumn("seq", F.transform("s", lambda x: F.struct(x["hi"], x["lo"], x["n"]))).drop("s")
    kind = "array<struct<hi: bigint, lo: bigint, n: int>>"
    # a conversation that ends with a whole segment, or has no turn, ends with an empty one
    ended = convs.filter(F.col("size") % segment == 0).select(
        "conv", "size", F.floor(F.col("size") / segment).alias("seg"), F.lit(0).cast("long").alias("x_hi"),
        F.lit(0).cast("long").alias("x_lo"), F.expr(f"cast(array() as {kind})").alias("seq"))
    segs = stored(segs.withColumn("seq", F.col("seq").cast(kind)).unionByName(ended), "segments")
    long = F.col("size") >= segment
    before = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    heads = segs.filter(long).select("conv", "seg", "x_hi", "x_lo").select(
        "conv", "seg", *[F.coalesce(F.expr(f"bit_xor(x_{x})").over(before), zero).alias(x) for x in HEAD])
    under = segs.filter(~long).withColumns({"hi": zero, "lo": zero}).unionByName(
        segs.filter(long).join(heads, ["conv", "seg"]))
    return under.select(
        "hi", "lo", (F.col("seg") * segment).alias("depth"), "seq",
        F.col("hi").bitwiseXOR(F.col("x_hi")).alias("end_hi"), F.col("lo").bitwiseXOR(F.col("x_lo")).alias("end_lo"),
        (F.col("seg") < F.floor(F.col("size") / segment)).alias("more"), "conv")


def _xor(head: str, seq: Column, part: str) -> Column:
    return F.aggregate(seq, F.col(head), lambda a, x: a.bitwiseXOR(x[part]))


def burst(live: DataFrame, container: int) -> tuple[list, list, list]:
    """Burst until no container is oversized: the containers left, the heads' chains, the links, a list per round."""
    left, chains, links = [], [], []
    while True:
        weight = F.sum(F.size("seq") + 1)
        big = stored(live.groupBy(*HEAD).agg(weight.alias("w8")).filter(F.col("w8") > container).select(*HEAD), "oversized")
        big = _small(big)
        left.append(live.join(big, HEAD, "left_anti"))
        if not big.limit(1).count():
            return left, chains, links
        out = live.join(big, HEAD)
        # the container's smallest and largest suffix tell what all of them share
        stats = out.groupBy(*HEAD).agg(
            F.min("depth").alias("depth"), F.sum("w").alias("n_convs"), F.min("conv").alias("conv"),
            F.min(F.struct("seq", "w", "conv")).alias("a"), F.max("seq").alias("z"))
        same = F.zip_with("a.seq", "z", lambda x, y: F.coalesce(
            (x["hi"] == y["hi"]) & (x["lo"] == y["lo"]), F.lit(False)))
        k = F.coalesce(F.array_position(same, F.lit(False)), F.lit(0))
        stats = stats.withColumn("k", F.when(k > 0, k - 1).otherwise(F.size("a.seq")).cast("int"))
        stats = stats.withColumn("shared", F.slice("a.seq", F.lit(1), F.col("k")))
        stats = stored(stats.select(
            *HEAD, "depth", "n_convs", "conv", "k", "shared", _xor("hi", F.col("shared"), "hi").alias("k_hi"),
            _xor("lo", F.col("shared"), "lo").alias("k_lo"),
            F.when(F.size("a.seq") == F.col("k"), F.struct("a.w", "a.conv")).alias("ends")), "chains")
        chains.append(stats)
        at = _small(stats.select(*HEAD, "k", "k_hi", "k_lo", F.col("conv").alias("up")))
        nxt = F.col("seq")[F.col("k")]
        down = stored(out.join(at, HEAD).filter(F.size("seq") > F.col("k")).select(
            F.col("hi").alias("p_hi"), F.col("lo").alias("p_lo"), "up", nxt["n"].alias("last"),
            F.col("k_hi").bitwiseXOR(nxt["hi"]).alias("hi"), F.col("k_lo").bitwiseXOR(nxt["lo"]).alias("lo"),
            (F.col("depth") + F.col("k") + 1).alias("depth"), "end_hi", "end_lo", "more", "conv", "w",
            F.slice("seq", F.col("k") + 2, F.greatest(F.size("seq") - F.col("k") - 1, F.lit(0))).alias("seq")), "burst")
        links.append(down.groupBy(*HEAD, "p_hi", "p_lo").agg(F.min("up").alias("up"), F.min("last").alias("last")))
        # what ends a segment here goes on in the container of the next one, which has the same head
        live = down.filter("size(seq) > 0 or not more").drop("p_hi", "p_lo", "up", "last")


NODE = ("kind int, hi long, lo long, p_hi long, p_lo long, depth long, conv_id long, parent_conv_id long, n_convs long, "
        "n_children long, n_leaves long, saved long, last long, n_ends long, end_conv long, linked boolean")
_NAMES = [f.split()[0] for f in NODE.split(", ")]


class _Container:
    """The nodes of one container, made from its sorted suffixes."""

    def __init__(self, hi: int, lo: int, depth: int):
        self.hi, self.lo = hi, lo
        self.nodes: list[dict] = []
        self.stack: list[dict] = []
        self.links: list[tuple] = []
        self.last: list[tuple] = []
        self._open(hi, lo, depth, None, 0)

    def _open(self, hi: int, lo: int, depth: int, parent: dict | None, n: int) -> None:
        node = {"hi": hi, "lo": lo, "depth": depth, "parent": parent, "last": n, "n_convs": 0, "conv_id": None,
                "n_children": 0, "n_leaves": 0, "saved": 0, "n_ends": 0, "end_conv": None}
        if parent is not None:
            parent["n_children"] += 1
        self.nodes.append(node)
        self.stack.append(node)

    def close(self, down_to: int) -> None:
        while len(self.stack) > down_to:
            node = self.stack.pop()
            if not node["n_children"]:
                node["n_leaves"] = 1
            up = node["parent"]
            if up is not None:  # what the head's own last text saves is added where its link is known
                node["saved"] += (node["n_convs"] - 1) * node["last"]
                up["n_convs"] += node["n_convs"]
                up["conv_id"] = node["conv_id"] if up["conv_id"] is None else min(up["conv_id"], node["conv_id"])
                up["n_leaves"] += node["n_leaves"]
                up["saved"] += node["saved"]

    def add(self, seq: list[tuple], more: bool, conv: int, w: int) -> None:
        same, most = 0, min(len(seq), len(self.last))
        while same < most and seq[same][:2] == self.last[same][:2]:
            same += 1
        self.last = seq
        nodes = len(seq) - more  # the segment's last turn, if it leads on, is the next container's head
        self.close(same + 1)
        for k in range(same, nodes):
            up, (hi, lo, n) = self.stack[-1], seq[k]
            self._open(up["hi"] ^ hi, up["lo"] ^ lo, up["depth"] + 1, up, n)
        node = self.stack[-1]
        node["n_convs"] += w
        node["conv_id"] = conv if node["conv_id"] is None else min(node["conv_id"], conv)
        if more:
            hi, lo, n = seq[-1]
            node["n_children"] += 1
            self.links.append((node["hi"] ^ hi, node["lo"] ^ lo, node, n, list(self.stack)))
        else:
            node["n_ends"], node["end_conv"] = w, conv

    def rows(self) -> Iterator[tuple]:
        self.close(0)
        linked = bool(self.links)
        for x in self.nodes:
            up = x["parent"]
            yield (1 if up is None else 0, x["hi"], x["lo"], self.hi, self.lo, x["depth"], x["conv_id"],
                   None if up is None else up["conv_id"], x["n_convs"], x["n_children"], x["n_leaves"], x["saved"],
                   x["last"], x["n_ends"], x["end_conv"], linked)
        for hi, lo, up, n, path in self.links:
            rest = (None,) * 4
            yield (2, hi, lo, self.hi, self.lo, None, None, up["conv_id"], *rest, n, None, None, None)
            for x in path[1:]:  # nodes whose subtree goes on under that head
                yield (3, hi, lo, x["hi"], x["lo"], None, None, None, *rest, None, None, None, None)


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``NODE`` from suffixes sorted by head and sequence.

    Kinds: 0 node, 1 a container's head, 2 link to the head of a next segment, 3 a node above such a head.
    """
    kinds = [pa.int32(), *[pa.int64()] * 14, pa.bool_()]

    def out(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=_NAMES)

    now, held = None, []
    for b in batches:
        seqs = b.column("seq")
        flat = seqs.flatten()
        place = [0, *(seqs.value_lengths().to_numpy(zero_copy_only=False).cumsum().tolist())]
        his, los, ns = (flat.field(i).to_pylist() for i in range(3))
        for i, (hi, lo, depth, more, conv, w) in enumerate(zip(*[
                b.column(c).to_pylist() for c in ("hi", "lo", "depth", "more", "conv", "w")])):
            if now is None or (now.hi, now.lo) != (hi, lo):
                if now is not None:
                    held += now.rows()
                now = _Container(hi, lo, depth)
            lo_, hi_ = place[i], place[i + 1]
            now.add(list(zip(his[lo_:hi_], los[lo_:hi_], ns[lo_:hi_])), more, conv, w)
            if len(held) > 5000:
                yield out(held)
                held = []
    if now is not None:
        held += now.rows()
    if held:
        yield out(held)


def totals(heads: DataFrame) -> DataFrame:
    """``hi, lo, n_leaves, saved`` summed over all heads below, itself included, by pointer doubling.

    ``heads``: ``hi, lo, p_hi, p_lo, n_leaves, saved``.  A round adds to each head what those hold that point to it,
    then lets every pointer skip to its target's.
    """
    now = heads
    while now.filter("p_hi is not null").limit(1).count():
        gains = now.filter("p_hi is not null").groupBy(F.col("p_hi").alias("hi"), F.col("p_lo").alias("lo")).agg(
            F.sum("n_leaves").alias("g_leaves"), F.sum("saved").alias("g_saved"))
        up = now.select(F.col("hi").alias("p_hi"), F.col("lo").alias("p_lo"), F.col("p_hi").alias("q_hi"),
                        F.col("p_lo").alias("q_lo"))
        now = stored(now.join(gains, HEAD, "left").join(up, ["p_hi", "p_lo"], "left").select(
            "hi", "lo", F.col("q_hi").alias("p_hi"), F.col("q_lo").alias("p_lo"),
            (F.col("n_leaves") + F.coalesce("g_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("g_saved", F.lit(0))).alias("saved")), "totals")
    return now.select("hi", "lo", F.col("n_leaves").alias("t_leaves"), F.col("saved").alias("t_saved"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node, joined by commas."""
    key, ids = None, []

    def out():
        return pa.RecordBatch.from_pydict({"hi": [key[0]], "lo": [key[1]], "first": [ids[0]], "n": [len(ids)],
                                           "part": [",".join(map(str, ids))]})
    for b in batches:
        for hi, lo, conv in zip(*(b.column(c).to_pylist() for c in ("end_hi", "end_lo", "conv"))):
            if key != (hi, lo) or len(ids) >= CHUNK:
                if ids:
                    yield out()
                key, ids = (hi, lo), []
            ids.append(conv)
    if ids:
        yield out()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks in a row."""
    key, run = None, None

    def out():
        return pa.RecordBatch.from_pydict({"hi": [key[0]], "lo": [key[1]], "ends_sha256": [run.hexdigest()]})
    for b in batches:
        for hi, lo, part in zip(*(b.column(c).to_pylist() for c in ("hi", "lo", "part"))):
            if key != (hi, lo):
                if run is not None:
                    yield out()
                key, run = (hi, lo), sha256(part.encode())
            else:
                run.update(b"," + part.encode())
    if run is not None:
        yield out()


def end_digests(ends: DataFrame) -> DataFrame:
    """``hi, lo, ends_sha256`` for lists of members that end at a node (``end_hi, end_lo, conv``)."""
    by = ["end_hi", "end_lo", "conv"]
    parts = ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(
        _chunks, "hi long, lo long, first long, n long, part string")
    return parts.repartition(*HEAD).sortWithinPartitions(*HEAD, "first").select(*HEAD, "part").mapInArrow(
        _digests, "hi long, lo long, ends_sha256 string")


def prefix_nodes(conversations: DataFrame, segment: int = SEGMENT, container: int = CONTAINER) -> DataFrame:
    """A row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    spark = conversations.sparkSession
    ship(spark)
    convs, turns = rebuilt(turns_of(conversations))
    rows = stored(suffixes(convs, turns, segment), "suffixes")
    key = ["hi", "lo", "depth", "end_hi", "end_lo", "more"]
    live = stored(rows.groupBy(*key).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("w"), F.any_value("seq").alias("seq")), "containers")
    several = live.filter("w > 1 and not more").select("end_hi", "end_lo")
    digests = stored(end_digests(rows.filter("not more").join(several, ["end_hi", "end_lo"], "left_semi")), "ends")

    left, chains, links = burst(live, container)
    final = left[0]
    for x in left[1:]:
        final = final.unionByName(x)
    made = stored(final.select("hi", "lo", "depth", "seq", "more", "conv", "w").repartition(*HEAD).sortWithinPartitions(
        *HEAD, "seq").mapInArrow(sweep, NODE), "nodes")

    link = made.filter("kind = 2").groupBy(*HEAD, "p_hi", "p_lo").agg(
        F.min("parent_conv_id").alias("up"), F.min("last").alias("last"))
    for x in links:
        link = link.unionByName(x)
    link = stored(link, "links")
    chain = None
    for x in chains:
        chain = x if chain is None else chain.unionByName(x)
    own = F.aggregate("shared", F.lit(0).cast("long"), lambda a, x: a + x["n"])  # code points of the shared turns
    heads = made.filter("kind = 1").select("hi", "lo", "n_convs", "n_leaves", "saved")
    if chain is not None:
        heads = heads.unionByName(chain.select("hi", "lo", "n_convs", F.lit(0).cast("long").alias("n_leaves"),
                                               ((F.col("n_convs") - 1) * own).alias("saved")))
    heads = stored(heads.join(link, HEAD, "left").withColumn(
        "saved", F.col("saved") + (F.col("n_convs") - 1) * F.coalesce("last", F.lit(0))), "heads")
    total = stored(totals(heads.select("hi", "lo", "p_hi", "p_lo", "n_leaves", "saved")).join(
        heads.select("hi", "lo", "up", "last"), HEAD), "head-totals")

    out = ["hi", "lo", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "n_ends",
           "end_conv"]
    tops = made.filter("kind = 1").drop("n_leaves", "saved", "last", "parent_conv_id").join(total, HEAD).select(
        *[F.col({"parent_conv_id": "up", "n_leaves": "t_leaves", "saved": "t_saved"}.get(c, c)).alias(c) for c in out])
    inner = made.filter("kind = 0")
    below = made.filter("kind = 3").join(total, HEAD).groupBy(F.col("p_hi").alias("hi"), F.col("p_lo").alias("lo")).agg(
        F.sum("t_leaves").alias("t_leaves"), F.sum("t_saved").alias("t_saved"))
    more = inner.filter("linked").join(below, HEAD, "left").withColumns({
        "n_leaves": F.col("n_leaves") + F.coalesce("t_leaves", F.lit(0)),
        "saved": F.col("saved") + F.coalesce("t_saved", F.lit(0))})
    nodes = tops.unionByName(inner.filter("not linked").select(out)).unionByName(more.select(out))
    if chain is not None:
        nodes = nodes.unionByName(_chain_nodes(chain, total, link).select(out))
    nodes = nodes.withColumn("ends_sha256", F.when(F.col("n_ends") == 0, F.lit(NOTHING)).when(
        F.col("n_ends") == 1, F.sha2(F.col("end_conv").cast("string"), 256)))
    nodes = stored(nodes, "all-nodes")
    whole = nodes.filter("n_ends < 2").unionByName(
        nodes.filter("n_ends > 1").drop("ends_sha256").join(digests, HEAD))
    return whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        F.col("saved").alias("saved_tokens"), "ends_sha256")


def _chain_nodes(chain: DataFrame, total: DataFrame, link: DataFrame) -> DataFrame:
    """The nodes of burst containers: the head, then one for each turn that all its suffixes share."""
    born = link.groupBy(F.col("p_hi").alias("hi"), F.col("p_lo").alias("lo")).agg(F.count(F.lit(1)).alias("born"))
    rows = chain.join(total, HEAD).join(born, HEAD).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k"))))
    front = F.slice("shared", F.lit(1), F.col("i"))
    here = F.col("i") == F.col("k")
    zero = F.lit(0).cast("long")
    # the subtree of the i-th node lacks what the nodes before it save
    before = F.aggregate(F.slice("shared", F.lit(1), F.greatest(F.col("i") - 1, F.lit(0))), zero, lambda a, x: a + x["n"])
    spent = F.when(F.col("i") > 0, before + F.coalesce("last", F.lit(0))).otherwise(zero)
    return rows.select(
        _xor("hi", front, "hi").alias("hi"), _xor("lo", front, "lo").alias("lo"), F.col("conv").alias("conv_id"),
        (F.col("depth") + F.col("i")).alias("depth"),
        F.when(F.col("i") == 0, F.col("up")).otherwise(F.col("conv")).alias("parent_conv_id"), "n_convs",
        F.when(here, F.col("born")).otherwise(F.lit(1)).alias("n_children"), F.col("t_leaves").alias("n_leaves"),
        (F.col("t_saved") - (F.col("n_convs") - 1) * spent).alias("saved"),
        F.when(here & F.col("ends").isNotNull(), F.col("ends.w")).otherwise(zero).alias("n_ends"),
        F.when(here, F.col("ends.conv")).alias("end_conv"))
