import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wordmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tests run locally: give them their own checkpoint folder unless the
    # session already names one.
    os.environ.setdefault("WORDMILL_CHECKPOINT_DIR", tempfile.mkdtemp(prefix="wordmill-ckpt-"))
    session = build_session("local[4]", app_name="wordmill-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
