import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from trestle.session import build_session

    s = build_session("local[4]", shuffle_partitions=8, app="trestle-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from trestle.sources.tables import Tables

    return Tables(spark, SF_SMALL)


def rows(df, *cols):
    """Collect as a list of tuples (selected columns, in order)."""
    if cols:
        df = df.select(*cols)
    return [tuple(r) for r in df.collect()]
