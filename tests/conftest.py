import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quillmesh.session import get_session

    shared = tmp_path_factory.mktemp("shared")
    session = get_session("local[4]", "tests", **{"spark__sql__shuffle__partitions": "4", "spark__checkpoint__dir": f"file://{shared}", "spark__sql__warehouse__dir": f"file://{shared}/warehouse"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
