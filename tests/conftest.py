import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from paygrain.session import build_session

    scratch = tmp_path_factory.mktemp("scratch")
    session = build_session(
        "paygrain-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(scratch),
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
