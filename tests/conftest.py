import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlark.session import get_spark
    # spark.checkpoint.dir comes from the environment when set; otherwise
    # ledgerlark.session.checkpoint_dir registers a private folder
    s = get_spark("local[4]", 4, extra={"spark.driver.memory": "6g"})
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
