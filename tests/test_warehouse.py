"""Bucketed tables, and loads that become visible as a whole."""

import contextlib
import io
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from finlake.plans import ingest
from finlake.plans.fixtures import Fixtures
from finlake.sinks import warehouse
from finlake.sinks.bucketed import Layout, open_bucketed, write_bucketed
from finlake.sources import filings
from tools.plan_report import plan_text, summarise

from .conftest import SF_SMALL, rows
from .test_ingest import FOLDERS, _expected, stage

SUB = Layout("adsh", 4, ("adsh",), "folder")
COLS = ["adsh", "tag", "ddate", "qtrs", "segments", "value"]


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    real = warehouse.layouts
    monkeypatch.setattr(warehouse, "layouts", lambda sub, num, buckets: real(sub, num, 4))


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    fx = Fixtures(spark, SF_SMALL, materialize=False)
    root = str(tmp_path_factory.mktemp("raw"))
    stage(spark, fx, root, FOLDERS)
    return root, fx


def _no_broadcast(spark, fn):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        return fn()
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)


def _tree(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("== Final Plan ==")[1].split("== Initial Plan ==")[0], summarise(plan_text(df))


def test_bucketed_join_and_grouping_need_no_exchange(spark, scratch):
    layout = Layout("k", 8, ("v",))
    write_bucketed(spark.range(400).select((F.col("id") % 40).alias("k"), F.col("id").alias("v")), f"{scratch}/a", layout)
    write_bucketed(spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")), f"{scratch}/b",
                   Layout("k", 8, ("k",)))

    def run():
        a, b = open_bucketed(spark, f"{scratch}/a", layout), open_bucketed(spark, f"{scratch}/b", Layout("k", 8, ("k",)))
        out = a.join(b, "k").groupBy("k", "w").agg(F.sum("v").alias("s"))
        return rows(out), _tree(out)
    got, (tree, s) = _no_broadcast(spark, run)
    assert got == sorted(((k, 2 * k, sum(range(k, 400, 40))) for k in range(40)), key=repr)
    assert s["Exchange"] == 0 and s["SortMergeJoin"] == 1
    assert rows(spark.read.parquet(f"{scratch}/a")) == rows(open_bucketed(spark, f"{scratch}/a", layout))


@pytest.mark.parametrize("name", ["margins", "liquidity", "roe_roa", "cash_flow"])
def test_per_filing_kpis_shuffle_no_fact(spark, name):
    """Even without broadcasts the facts are joined to their filing and grouped by it where they lie."""
    def run():
        df = entry.queries()[name](spark, SF_SMALL)
        df.collect()
        return _tree(df)
    tree, s = _no_broadcast(spark, run)
    # the filings go to their companies and back into the facts' buckets, and the result is sorted; no fact moves
    moved = [line for line in tree.splitlines() if re.search(r"(?<!Broadcast)Exchange \w+partitioning", line)]
    assert len(moved) == 4 and s["Window"] == 0
    assert [re.search(r"hashpartitioning\((\w+)#\d+L?, \d+\)|(range)", m).group(1, 2) for m in moved] == [
        (None, "range"), ("adsh", None), ("cik", None), ("cik", None)]
    assert re.search(r"HashAggregate\(keys=\[symbol#\d+, cik#\d+L?, adsh", tree)


def test_load_in_two_steps_and_reload(spark, staged, scratch):
    root, fx = staged
    out = f"{scratch}/w"
    assert ingest.ingest_filings(spark, root, out, FOLDERS[:2], [1, 2, 3], None, sink="warehouse") == FOLDERS[:2]
    want_sub, want_num = _expected(fx, FOLDERS[:2], [1, 2, 3])
    assert rows(warehouse.read(spark, out, "fs_num"), *COLS) == rows(want_num, *COLS)
    assert rows(warehouse.read(spark, out, "fs_sub"), "adsh", "folder") == rows(want_sub, "adsh", "folder")
    before = warehouse.latest(spark, out)
    assert ingest.ingest_filings(spark, root, out, FOLDERS[1:], [1, 2, 3], None, sink="warehouse") == sorted(FOLDERS[2:])
    assert ingest.ingest_filings(spark, root, out, FOLDERS, [1, 2, 3], None, sink="warehouse") == []
    want_sub, want_num = _expected(fx, FOLDERS, [1, 2, 3])
    assert rows(warehouse.read(spark, out, "fs_num"), *COLS) == rows(want_num, *COLS)
    assert rows(warehouse.recorded(spark, out)) == [(f,) for f in sorted(FOLDERS)]
    # an earlier version stays readable
    assert warehouse.read(spark, out, "fs_sub", before).select("folder").distinct().count() == 2
    # a quarter is loaded again, for fewer companies: only its rows change
    assert ingest.load_warehouse(spark, root, out, [FOLDERS[0]], [1], replace=True) == [FOLDERS[0]]
    sub = warehouse.read(spark, out, "fs_sub")
    assert {r.cik for r in sub.filter(F.col("folder") == FOLDERS[0]).collect()} == {1}
    assert sub.filter(F.col("folder") != FOLDERS[0]).count() == want_sub.filter(F.col("folder") != FOLDERS[0]).count()


def test_a_load_that_dies_before_publishing_shows_nothing(spark, staged, scratch, monkeypatch):
    root, fx = staged
    out = f"{scratch}/w"
    ingest.load_warehouse(spark, root, out, [FOLDERS[0]], [1])

    def dies(*args):
        raise RuntimeError("lost")
    # between the two tables, and between the tables and the manifest
    for name in ("write_bucketed", "publish"):
        with monkeypatch.context() as m:
            calls = []
            real = getattr(warehouse, name)
            m.setattr(warehouse, name, lambda *a: (calls.append(1), real(*a) if name == "write_bucketed" and
                                                   len(calls) == 1 else dies())[1])
            with pytest.raises(RuntimeError):
                ingest.load_warehouse(spark, root, out, FOLDERS[1:3], [1])
        assert warehouse.latest(spark, out).version == 1
        assert {r.folder for r in warehouse.read(spark, out, "fs_num").collect()} == {FOLDERS[0]}
        assert {r.folder for r in warehouse.read(spark, out, "fs_sub").collect()} == {FOLDERS[0]}
    assert ingest.load_warehouse(spark, root, out, FOLDERS[1:3], [1]) == FOLDERS[1:3]
    assert warehouse.read(spark, out, "fs_sub").count() == _expected(fx, FOLDERS[:3], [1])[0].count()


def test_two_loaders_cannot_both_win(spark, staged, scratch, monkeypatch):
    """Both read version 0 and write; the second one to publish finds its version taken."""
    root, fx = staged
    out = f"{scratch}/w"
    real, other = warehouse.publish, []

    def publish(sp, where, manifest):
        if not other:  # the other loader publishes first: one common quarter, one of its own
            other.append(1)
            ingest.load_warehouse(spark, root, out, [FOLDERS[0], FOLDERS[2]], [1, 2])
        return real(sp, where, manifest)
    monkeypatch.setattr(warehouse, "publish", publish)
    assert ingest.load_warehouse(spark, root, out, FOLDERS[:2], [1, 2]) == [FOLDERS[1]]
    m = warehouse.latest(spark, out)
    assert m.version == 2 and m.recorded == sorted(FOLDERS[:3])
    assert not real(spark, out, warehouse.Manifest(2))
    want_sub, want_num = _expected(fx, FOLDERS[:3], [1, 2])
    assert rows(warehouse.read(spark, out, "fs_num"), *COLS) == rows(want_num, *COLS)


def test_other_columns_are_refused(spark, scratch):
    first = warehouse.write_load(spark, scratch, {"fs_sub": (spark.createDataFrame(
        [("a", "2020q1")], "adsh string, folder string"), SUB)})
    assert warehouse.commit(spark, scratch, first, ["2020q1"]) == ["2020q1"]
    other = warehouse.write_load(spark, scratch, {"fs_sub": (spark.createDataFrame(
        [("a", 1, "2020q2")], "adsh string, cik int, folder string"), SUB)})
    with pytest.raises(ValueError):
        warehouse.commit(spark, scratch, other, ["2020q2"])
    assert warehouse.latest(spark, scratch).recorded == ["2020q1"]


def test_part_files_of_one_folder_with_their_own_headers(spark, scratch):
    """Two part files of num.txt differ in column order; blanks in a path and empty files do no harm."""
    folder = os.path.join(scratch, "a b", "2024q1", "num.txt")
    os.makedirs(folder)
    for name, text in (("part-0", "adsh\ttag\tddate\tqtrs\tuom\tvalue\na1\tAssets\t20240331\t0\tUSD\t1\n"),
                       ("part-1", "value\tuom\tqtrs\tddate\ttag\tadsh\r\n2\tUSD\t4\t20240331\tNetIncomeLoss\ta2\r\n"),
                       ("part-2", ""), ("part-3", "adsh\ttag\tvalue\n")):
        with open(os.path.join(folder, name), "w", newline="") as fh:
            fh.write(text)
    got = rows(filings.read_num(spark, os.path.join(scratch, "a b"), ["2024q1"]),
               "folder", "adsh", "tag", "qtrs", "uom", "value")
    assert got == [("2024q1", "a1", "Assets", 0, "USD", 1.0), ("2024q1", "a2", "NetIncomeLoss", 4, "USD", 2.0)]


def test_a_file_without_header_is_an_error(spark, scratch):
    os.makedirs(os.path.join(scratch, "2024q1"))
    with open(os.path.join(scratch, "2024q1", "num.txt"), "w") as fh:
        fh.write("a1\tAssets\t20240331\n")
    with pytest.raises(ValueError, match="no header"):
        filings.read_num(spark, scratch, ["2024q1"])


def test_header_read_is_one_scan(spark, staged):
    """The header read is one query, whatever the number of folders."""
    root, _ = staged
    found = filings.layouts(spark, [f"{root}/{f}/num.txt" for f in FOLDERS])
    assert sorted(len(v) for v in found.values()) == [len(FOLDERS)]
