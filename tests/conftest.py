import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from labelforge.plans.session import local_session

    session = local_session(8, "tests", {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
