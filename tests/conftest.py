import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tideline.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app="tideline-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (NULLs first) for order-insensitive asserts."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()),
                  key=lambda t: tuple((x is not None, x) for x in t))
