import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture()
def workspace(spark):
    from barloom.session import Workspace

    with Workspace(spark, "test") as ws:
        yield ws
