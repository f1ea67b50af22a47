import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quayside.session import get_session

    s = get_session("local[4]", 8, app="quayside-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def write_bytes(folder: str, name: str, data: bytes) -> str:
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)
    return path


@pytest.fixture()
def writer():
    return write_bytes


@pytest.fixture(scope="session")
def scratch_root():
    return tempfile.mkdtemp(prefix="quayside-test-")
