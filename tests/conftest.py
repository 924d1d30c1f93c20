import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from paidpath.session import build_session, ensure_checkpoint_dir
    s = build_session("local[4]", app="paidpath-tests", shuffle_partitions=8, driver_memory="6g")
    # tests have no cluster: install a checkpoint folder only because none is set
    ensure_checkpoint_dir(s, str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()
