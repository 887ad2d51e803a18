import os
import sys
from pathlib import Path

import pytest

os.environ.setdefault("PYTHONDONTWRITEBYTECODE", "1")
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = Path(os.environ.get("TEST_DATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import local_session

    session = local_session(4, 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def smallest():
    folder = DATA / "sf0.001"
    if not folder.exists():
        pytest.skip("no test tables here")
    return str(folder)
