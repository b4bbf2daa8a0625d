import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from marlake.session import drop_scratch, local_session

    session = local_session(8, "marlake-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture
def many_chunks(monkeypatch):
    """Chunks of few rows, so that small groups cross chunk borders as large ones would."""
    from marlake.operators import ordered

    monkeypatch.setattr(ordered, "CHUNK_ROWS", 100)
    monkeypatch.setattr(ordered, "SAMPLES", 4)
