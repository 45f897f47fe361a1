import os
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tidemark-tests", cores="4")
    session.sparkContext.setLogLevel("ERROR")
    for setting in os.environ.get("TEST_CONF", "").split():
        session.conf.set(*setting.split("=", 1))
    yield session
    session.stop()
