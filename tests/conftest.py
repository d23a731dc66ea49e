import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]


@pytest.fixture(scope="session")
def spark():
    from quern.session import local_session

    session = local_session(8, 4, name="tests")
    session.sparkContext.setLogLevel("OFF")
    return session
