import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rivulet.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="rivulet-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rivulet-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rivulet-test-")


def rows(df, *cols):
    """Sorted list of tuples for order-insensitive comparison."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
