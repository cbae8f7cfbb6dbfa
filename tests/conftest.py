import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from loadwright.session import local_session

    s = local_session("*", shuffle_partitions=8, app="loadwright-tests")
    yield s


@pytest.fixture
def write_text(tmp_path):
    """Write lines to a text file (one delivery) and return its path."""
    def _write(name, lines, folder=None):
        d = tmp_path if folder is None else tmp_path / folder
        d.mkdir(parents=True, exist_ok=True)
        p = d / name
        p.write_text("".join(line + "\n" for line in lines), encoding="utf-8")
        return str(p)
    return _write
