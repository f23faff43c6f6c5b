"""Filing ingest: staged TSV folders -> filter -> period facts -> partitioned tables + ledger."""

import os
import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

from finlake.plans import ingest
from finlake.plans.fixtures import Fixtures
from finlake.sinks import writers
from finlake.sources.text import read_zip_members, tab_fields

from .conftest import SF_SMALL, rows

SUB_HEADER = ["adsh", "cik", "name", "sic", "zipba", "form", "period", "fy", "fp", "filed"]
NUM_HEADER = ["adsh", "tag", "version", "coreg", "ddate", "qtrs", "uom", "segments", "value",
              "footnote"]
FOLDERS = ["1995q1", "1995q2", "1995q3", "1996q1"]


def _tsv(records, header):
    out = ["\t".join(header)]
    for r in records:
        out.append("\t".join("" if r.get(h) is None else str(r[h]) for h in header))
    return "\n".join(out) + "\n"


def stage(spark, fx, root, folders):
    """Write quarter folders of sub.txt/num.txt from the fixture tables."""
    sub = fx.fs_sub.filter(F.col("folder").isin(folders)).toPandas()
    num = fx.fs_num_raw.join(fx.fs_sub.select("adsh", "folder"), "adsh") \
        .filter(F.col("folder").isin(folders)).toPandas()
    for folder in folders:
        d = os.path.join(root, folder)
        os.makedirs(d)
        s = sub[sub.folder == folder]
        recs = [{"adsh": r.adsh, "cik": r.cik, "name": f'Co "{r.cik}"', "sic": 1000,
                 "zipba": "x", "form": r.form, "period": r.period.strftime("%Y%m%d"),
                 "fy": r.fy, "fp": r.fp, "filed": "20200101"} for r in s.itertuples()]
        # an 8-K filing of the first company: must be dropped by the form filter
        recs.append({"adsh": f"8k-{folder}", "cik": 1, "form": "8-K", "period": "19950331",
                     "fy": 1995, "fp": "Q1"})
        with open(os.path.join(d, "sub.txt"), "w") as fh:
            fh.write(_tsv(recs, SUB_HEADER))
        n = num[num.folder == folder]
        nrecs = [{"adsh": r.adsh, "tag": r.tag, "version": "us-gaap/2020", "ddate":
                  r.ddate.strftime("%Y%m%d"), "qtrs": r.qtrs, "uom": r.uom,
                  "segments": r.segments, "value": repr(r.value)} for r in n.itertuples()]
        with open(os.path.join(d, "num.txt"), "w") as fh:
            fh.write(_tsv(nrecs, NUM_HEADER))


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """A few staged quarter folders."""
    fx = Fixtures(spark, SF_SMALL, materialize=False)
    root = str(tmp_path_factory.mktemp("raw"))
    stage(spark, fx, root, FOLDERS)
    return root, fx


def _expected(fx, folders, companies):
    sub = fx.fs_sub.filter(F.col("folder").isin(folders) & F.col("cik").isin(companies))
    return sub, ingest.keep_period_facts(fx.fs_num_raw, sub)


def test_ingest_then_rerun_is_idempotent(spark, staged, scratch):
    root, fx = staged
    out, ledger = os.path.join(scratch, "tables"), os.path.join(scratch, "ledger")
    companies = [1, 2, 3]
    loaded = ingest.ingest_filings(spark, root, out, FOLDERS[:2], companies, ledger)
    assert loaded == FOLDERS[:2]
    sub, num = ingest.read_loaded(spark, out)
    want_sub, want_num = _expected(fx, FOLDERS[:2], companies)
    assert rows(sub, "adsh", "cik", "form", "period", "fy", "fp", "folder") == \
        rows(want_sub, "adsh", "cik", "form", "period", "fy", "fp", "folder")
    cols = ["adsh", "tag", "ddate", "qtrs", "segments", "value"]
    assert rows(num, *cols) == rows(want_num, *cols)
    assert "version" not in num.columns and "8-K" not in {r.form for r in sub.collect()}

    # second run: one folder already recorded, one new
    again = ingest.ingest_filings(spark, root, out, FOLDERS[1:3], companies, ledger)
    assert again == [FOLDERS[2]]
    sub, num = ingest.read_loaded(spark, out)
    assert sub.select("adsh").distinct().count() == sub.count()
    want_sub, want_num = _expected(fx, FOLDERS[:3], companies)
    assert num.count() == want_num.count()
    assert ingest.ingest_filings(spark, root, out, FOLDERS[:3], companies, ledger) == []

    # the ledger was lost: re-loading overwrites the folder partitions, no duplicates
    ledger2 = os.path.join(scratch, "ledger2")
    ingest.ingest_filings(spark, root, out, FOLDERS[:3], companies, ledger2)
    sub, num = ingest.read_loaded(spark, out)
    assert num.count() == want_num.count()


def test_pending_folders(spark):
    req = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "f string")
    led = spark.createDataFrame([("b",)], writers.LEDGER_SCHEMA)
    assert rows(writers.pending_folders(req, led)) == [("a",), ("c",)]


def test_zip_members_to_fields(spark, scratch):
    path = os.path.join(scratch, "2009q1.zip")
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("num.txt", "adsh\ttag\tvalue\nx\tRevenues\t1.5\ny\tAssets\t\n")
        zf.writestr("sub.txt", "adsh\tcik\nx\t1\n")
    lines = read_zip_members(spark, os.path.join(scratch, "*.zip"), "num.txt", chunk_lines=1)
    got = rows(tab_fields(lines, ["adsh", "tag", "value"]), "adsh", "tag", "value")
    assert got == [("x", "Revenues", "1.5"), ("y", "Assets", None)]
    assert lines.count() == 3


def test_folders_of_different_layouts_read_by_name(spark, scratch):
    """Columns that moved, appeared or are missing in one quarter don't shift another quarter's."""
    files = {
        "2020q1": ("adsh\ttag\tversion\tcoreg\tddate\tqtrs\tuom\tvalue", "a1\tAssets\tv\t\t20200331\t0\tUSD\t1.5"),
        "2025q1": ("adsh\ttag\tversion\tddate\tqtrs\tuom\tsegments\tcoreg\tvalue\tfootnote",
                   "a2\tAssets\tv\t20250331\t0\tUSD\tSeg\t\t2.5\t\na3\tAssets\tv\tbad\tx\tUSD\t\t\tbad\t"),
    }
    for folder, (header, body) in files.items():
        os.makedirs(os.path.join(scratch, folder))
        with open(os.path.join(scratch, folder, "num.txt"), "w") as fh:
            fh.write(f"{header}\n{body}\n")
        with open(os.path.join(scratch, folder, "sub.txt"), "w") as fh:
            fh.write("adsh\tcik\tfy\na\t1\t2020\n" if folder == "2020q1" else "fy\tname\tcik\tadsh\n2025\tN\t2\tb\n")
    from finlake.sources import filings

    both = filings.read_num(spark, scratch, ["2020q1", "2025q1"])
    apart = [filings.read_num(spark, scratch, [f]) for f in files]
    assert rows(both) == rows(apart[0].unionByName(apart[1]))
    got = {r.adsh: (r.folder, str(r.ddate), r.qtrs, r.segments, r.value) for r in both.collect()}
    assert got["a1"] == ("2020q1", "2020-03-31", 0, None, 1.5)
    assert got["a2"] == ("2025q1", "2025-03-31", 0, "Seg", 2.5)
    assert got["a3"] == ("2025q1", "None", None, None, None)          # bad fields don't stop the load
    bad = {r.folder: (r.facts, r.bad_ddate, r.bad_qtrs, r.bad_value)
           for r in filings.rejects(spark, scratch, list(files)).collect()}
    assert bad == {"2020q1": (1, 0, 0, 0), "2025q1": (2, 1, 1, 1)}
    sub = {r.adsh: (r.cik, r.fy, r.name) for r in filings.read_sub(spark, scratch, list(files)).collect()}
    assert sub == {"a": (1, 2020, None), "b": (2, 2025, "N")}


def test_half_written_fixture_table_is_rebuilt(spark):
    fx = Fixtures(spark, SF_SMALL)
    whole = fx.fs_sub.count()
    path = fx._path(f"half-{uuid.uuid4().hex}")
    fx.fs_sub.limit(3).write.parquet(path)
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    marker.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(marker, False)
    assert fx._stored(path, lambda: fx.fs_sub).count() == whole
    assert fx._stored(path, lambda: fx.fs_sub.limit(0)).count() == whole     # a finished one is kept


def test_input_key_follows_the_files(spark, scratch):
    from finlake.plans.fixtures import SOURCES, _input_key

    for t in SOURCES:
        spark.range(3).write.parquet(os.path.join(scratch, f"{t}.parquet"))
    before = _input_key(spark, scratch)
    assert before == _input_key(spark, scratch + "/")
    spark.range(4).write.mode("append").parquet(os.path.join(scratch, "labels.parquet"))
    assert before != _input_key(spark, scratch)
