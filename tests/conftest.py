import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from checks.compare import session

    return session("8")


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
