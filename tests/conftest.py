import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from oddsline.session import build_session, checkpoint_dir

    s = build_session(master="local[*]", shuffle_partitions=8, app="oddsline-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
