import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidewatch.session import build_session
    shared = str(tmp_path_factory.mktemp("shared"))
    s = build_session(master="local[4]", shuffle_partitions=8, extra={"spark.checkpoint.dir": shared})
    yield s
    s.stop()
