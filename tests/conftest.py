import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from finlake.session import build_session, ensure_checkpoint_dir

    s = build_session("finlake-tests", master="local[4]", shuffle_partitions=8)
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="finlake-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="finlake-test-", dir="/tmp")


def rows(df, *cols):
    """Collected rows as tuples (sorted), optionally projected."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
