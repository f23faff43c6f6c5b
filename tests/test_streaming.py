"""Incremental ingest: folders landing over time are each loaded once."""

import os
import shutil

from finlake.plans import ingest
from finlake.sinks import writers
from finlake.streaming.filings_stream import start_filing_stream

from .test_ingest import FOLDERS, staged  # noqa: F401  (module fixture)


def test_stream_loads_new_folders_once(spark, staged, scratch):  # noqa: F811
    root, fx = staged
    landing = os.path.join(scratch, "landing")
    out = os.path.join(scratch, "tables")
    ledger = os.path.join(scratch, "ledger")
    ckpt = os.path.join(scratch, "ckpt")
    os.makedirs(landing)
    for f in FOLDERS[:2]:
        shutil.copytree(os.path.join(root, f), os.path.join(landing, f))

    q = start_filing_stream(spark, landing, out, ledger, [1, 2, 3], checkpoint=ckpt)
    q.awaitTermination(300)
    assert sorted(r.folder_name for r in writers.read_ledger(spark, ledger).collect()) == FOLDERS[:2]

    # a later run sees only the folder that arrived since
    shutil.copytree(os.path.join(root, FOLDERS[2]), os.path.join(landing, FOLDERS[2]))
    q = start_filing_stream(spark, landing, out, ledger, [1, 2, 3], checkpoint=ckpt)
    q.awaitTermination(300)
    led = [r.folder_name for r in writers.read_ledger(spark, ledger).collect()]
    assert sorted(led) == FOLDERS[:3] and len(led) == 3
    sub, num = ingest.read_loaded(spark, out)
    assert sorted(r.folder for r in sub.select("folder").distinct().collect()) == FOLDERS[:3]
    assert sub.select("adsh").distinct().count() == sub.count()


def test_folder_waits_for_its_second_file(spark, staged, scratch):  # noqa: F811
    root, fx = staged
    landing, folder = os.path.join(scratch, "landing"), FOLDERS[0]
    out, ledger, ckpt = (os.path.join(scratch, x) for x in ("tables", "ledger", "ckpt"))
    os.makedirs(os.path.join(landing, folder))

    def arrive(name):
        shutil.copy(os.path.join(root, folder, name), os.path.join(landing, folder, name))
        start_filing_stream(spark, landing, out, ledger, [1, 2, 3], checkpoint=ckpt).awaitTermination(300)
        return [r.folder_name for r in writers.read_ledger(spark, ledger).collect()]

    assert arrive("sub.txt") == []
    assert arrive("num.txt") == [folder]
    sub, num = ingest.read_loaded(spark, out)
    want = ingest.keep_period_facts(fx.fs_num_raw, fx.fs_sub.filter(f"folder = '{folder}' and cik in (1, 2, 3)"))
    assert num.count() == want.count()


def test_stream_into_the_warehouse(spark, staged, scratch, monkeypatch):  # noqa: F811
    from finlake.sinks import warehouse

    real = warehouse.layouts
    monkeypatch.setattr(warehouse, "layouts", lambda sub, num, buckets: real(sub, num, 4))
    root, _ = staged
    landing, out, ckpt = (os.path.join(scratch, x) for x in ("landing", "tables", "ckpt"))
    os.makedirs(landing)
    for k, folder in enumerate(FOLDERS[:2]):
        shutil.copytree(os.path.join(root, folder), os.path.join(landing, folder))
        start_filing_stream(spark, landing, out, companies=[1, 2], checkpoint=ckpt, sink="warehouse").awaitTermination(300)
        assert warehouse.latest(spark, out).recorded == FOLDERS[:k + 1]
    sub = warehouse.read(spark, out, "fs_sub")
    assert sub.select("adsh").distinct().count() == sub.count() > 0
