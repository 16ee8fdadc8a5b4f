import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cabflow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="cabflow-tests-")
    session = build_session(
        "local[4]",
        app_name="cabflow-tests",
        shuffle_partitions=4,
        extra_conf={
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": os.path.join(scratch, "shared"),
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
