import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ampere.session import local_test_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_test_session(cpus=os.environ.get("TEST_CPUS", "4"), partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
