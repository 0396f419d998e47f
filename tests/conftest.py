from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from trafficwatch.session import checkpoint_root, get_session

    # A session zone far from the declared one: results must not depend on it.
    session = get_session("local[4]", shuffle_partitions=8,
                          conf={"spark.sql.session.timeZone": "America/Los_Angeles"})
    checkpoint_root(session)
    yield session


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
