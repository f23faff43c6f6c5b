"""Keys, sources and ids that hold a large part of all rows."""

import random
from collections import Counter

from pyspark.sql import functions as F

from finlake.llm import mixing, ordering
from finlake.llm.hot import join_by_key
from finlake.llm.ordering import numbered


def test_positions_of_a_hot_group_spread_over_ranges(spark, monkeypatch):
    """A third of the rows are one group, a sixth one and the same row."""
    r = random.Random(3)
    rows = [("a", 7) if i % 6 == 0 else ("a", r.randint(0, 50)) if i % 3 == 0 else (f"g{i % 40}", r.randint(0, 9))
            for i in range(12000)]
    rows += [("b", None)] * 30
    df = spark.createDataFrame(rows, "_g string, v int").repartition(7)
    ranges = []
    monkeypatch.setattr(ordering, "stored", lambda df, name, real=ordering.stored: ranges.append(real(df, name)) or ranges[0])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = numbered(df, ["v"], "test")
        parts = [x["count"] for x in ranges[0].groupBy("_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(parts) < 3 * len(rows) / 8  # eight ranges
    got = {}
    for x in out.collect():
        got.setdefault(x["_g"], []).append((x["_pos"], x["v"]))
    assert sum(map(len, got.values())) == len(rows)
    for own in got.values():
        own.sort()
        assert [p for p, _ in own] == list(range(len(own)))
        order = [(v is not None, v or 0) for _, v in own]
        assert order == sorted(order)


def test_join_by_key_equals_a_join(spark):
    rows = [(i % 5 if i % 2 else 77, i) for i in range(6000)] + [(10**6 + i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(6)
    counts = Counter(k for k, _ in rows)
    table = spark.createDataFrame([(k, n, f"t{k}") for k, n in counts.items() if k != 3], "k long, n long, name string")
    got = sorted(map(tuple, join_by_key(df, table, "k", "n").select("k", "v", "name").collect()))
    assert got == sorted((k, v, f"t{k}") for k, v in rows if k != 3)
    assert join_by_key(df.filter("false"), table.filter("false"), "k", "n").count() == 0


def test_mixing_with_ten_thousand_rows_without_id(spark):
    rows = [(None, "w " * (i % 7), "en", "s") if i < 10000 else (i, "w " * (i % 31), "en", "s" if i % 3 else "t")
            for i in range(14000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    got = mixing.mix(docs).collect()
    assert len(got) == 14000 and sum(r.doc_id is None for r in got) == 10000
    for source in ("s", "t"):
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 64
        ranks = mixing.emit(docs.filter(F.col("source") == source), ["doc_id"], every=True).groupBy("rank").count()
        assert ranks.count() == len(own)
    whole = mixing.emit(docs)
    assert whole.count() == sum(r.copies for r in got)


def test_a_run_leaves_nothing_but_its_result(spark):
    import os

    import corpus_pipeline
    from finlake.llm.store import _written, mark

    from .data import SMALL

    since = mark(spark)
    docs = corpus_pipeline.run(spark, SMALL)
    left = [p for p in _written(spark)[since:] if p]
    assert len(left) == 1 and left[0].endswith("stage4-mixing-sources-to-target-weights")
    assert len([p for p in _written(spark) if p]) >= 1 and docs.count() > 0
    folder = left[0].replace("file:", "").rsplit("/", 2)[0]
    assert os.path.isdir(folder)
