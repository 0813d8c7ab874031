import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tintero.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(4, app="tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": f"file:{shared}",
        "spark.driver.memory": "4g",
    })
    yield session
    session.stop()
