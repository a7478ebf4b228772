from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from shelfcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions=4, memory="6g")
    yield session
    session.stop()
