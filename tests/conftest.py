import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TESTS = os.path.join(ROOT, "tests")
sys.path.insert(0, ROOT)
# Python workers unpickle client factories defined in the package and in tests.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, TESTS] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sftprep.session import build_session, checkpoint_root

    s = build_session("local[4]", app_name="sftprep-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # sets a private folder only when the session has none
    yield s
    s.stop()
