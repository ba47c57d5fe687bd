import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from laketide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    import tempfile
    wh = tempfile.mkdtemp(prefix="laketide-wh-")
    s = build_session("local[*]", app="laketide-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": wh})
    yield s


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
