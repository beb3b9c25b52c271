import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from landstrata.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("shared")
    session = local_session(8, 8, spark__checkpoint__dir=str(root))
    yield session
    session.stop()


@pytest.fixture
def sf():
    return SF
