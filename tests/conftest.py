import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from thermogrid.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="tg-test-ckpt-")
    s = get_spark("local[8]", app="thermogrid-tests", shuffle_partitions=8,
                  conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
