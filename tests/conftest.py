import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from barloom.session import prepare

    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="barloom-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def bars(spark, sf_dir):
    """Bars of all sizes, written once for the whole test run."""
    from barloom.session import Workspace
    from verification import fixtures

    return Workspace(spark, "test-bars", innermost=False).stage(fixtures.bars(spark, sf_dir), "bars")


@pytest.fixture(autouse=True)
def scratch(request):
    """Every test has a workspace, and nothing but what outlives it by design is left when it is over."""
    if "spark" not in request.fixturenames:
        yield None
        return
    from barloom.session import Workspace, open_workspaces, release

    spark = request.getfixturevalue("spark")
    before = open_workspaces(spark)
    with Workspace(spark, "test") as workspace:
        yield workspace
    shared = [w for w in open_workspaces(spark) if w.folder.rsplit("/", 1)[-1].startswith(("test-bars", "stored-bars"))]
    release(spark, [*before, *shared])
    left = {w.folder.rsplit("/", 1)[-1] for w in open_workspaces(spark)}
    top = os.path.dirname(workspace.folder)
    assert not os.path.isdir(top) or set(os.listdir(top)) <= left
