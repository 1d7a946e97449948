import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from renown.session import local_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", "renown-tests", spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    if not Path(TABLES).exists():
        pytest.skip("driver tables are missing")
    return TABLES
