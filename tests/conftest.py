import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from paceline.session import session

    s = session(os.environ.get("TEST_MASTER", "local[4]"), spark_sql_shuffle_partitions="4", spark_checkpoint_dir=f"file://{tmp_path_factory.mktemp('shared')}", spark_driver_memory="3g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"
