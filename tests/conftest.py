import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from repolens.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", 4)
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="repolens-test-")


def files_df(spark, items, repo="r"):
    """[(path, content)] -> files(repo, path, content)."""
    return spark.createDataFrame([(repo, p, c) for p, c in items], "repo string, path string, content string")
