import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sentiscope.session import get_spark

    session = get_spark(master="local[*]", shuffle_partitions=8, app_name="sentiscope-tests")
    yield session


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sentiscope-test-", dir="/tmp")
