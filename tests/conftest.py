import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from clickmart.session import build_session

    s = build_session(
        "local[4]",
        app_name="clickmart-tests",
        shuffle_partitions=8,
        extra={
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from oracle_check import duck
    from tables import SMALL

    return duck(SMALL)


@pytest.fixture(scope="session")
def duck_medium():
    from oracle_check import duck
    from tables import MEDIUM

    return duck(MEDIUM)
