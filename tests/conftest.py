from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from trip_star.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="trip-star-tests-")


@pytest.fixture(scope="session")
def spark(scratch):
    session = get_session(
        "local[4]",
        app_name="trip_star_tests",
        shuffle_partitions=8,
        checkpoint_dir=os.path.join(scratch, "checkpoints"),
        extra_conf={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


def rows(df, *order):
    """Collect a small test frame as sorted tuples."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
