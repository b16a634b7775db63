import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from lakeloom.session import build_session
    # a fresh warehouse per run: catalog tables of one run never collide with
    # leftovers of another, and nothing is written into the repository
    warehouse = tempfile.mkdtemp(prefix="lakeloom-warehouse-")
    s = build_session("local[4]", app="lakeloom-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="lakeloom-test-")


def rows(df, order=None):
    """Collected rows as sorted tuples of python values."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
