import os
import pathlib
import sys
import tempfile

import pytest

# one session serves all tests: plans, broadcasts and code of some 400 of them need more than the default of 1 GB
os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 6g pyspark-shell")
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from tallyframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture()
def rows():
    """Collected rows as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
