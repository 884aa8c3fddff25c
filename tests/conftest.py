import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from voicetide.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        "4", "tests",
        **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": folder,
           "spark.driver.memory": "6g", "spark.sql.maxMetadataStringLength": "10000"},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
