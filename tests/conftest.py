import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tertulia.session import build_session

    return build_session(
        master="local[8]",
        **{"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))},
    )


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
