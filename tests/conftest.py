import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from msgmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        8, **{"spark.sql.warehouse.dir": str(root), "spark.checkpoint.dir": str(root / "shared")}
    )
    yield session
    session.stop()
