import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from tallyforge.session import local_session

    session = local_session(cpus=4, partitions=4, memory="6g")
    yield session
    session.stop()
