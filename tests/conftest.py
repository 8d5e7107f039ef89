import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from panelkit.session import checkpoint_dir, get_session

    s = get_session("local[4]", "panelkit-tests", shuffle_partitions=4,
                    extra={"spark.driver.memory": "8g"})
    # Tests only: install a checkpoint folder when the session names none.
    checkpoint_dir(s, tempfile.mkdtemp(prefix="panelkit-test-chk-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="panelkit-test-")
