import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from careflow.session import get_session
    ckpt = tempfile.mkdtemp(prefix="careflow-test-ckpt-")
    s = get_session("local[4]", app_name="careflow-tests", shuffle_partitions=8,
                    extra={"spark.ui.showConsoleProgress": "false",
                           "spark.checkpoint.dir": ckpt,
                           "spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="careflow-test-")
