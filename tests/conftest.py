import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fundlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def land(spark):
    """Landing table from ``(site_type, url, portfolio_id, endpoint, page, body)`` rows."""
    import datetime

    from fundlake.schemas import RESPONSES

    at = datetime.datetime(2024, 1, 1)

    def build(*rows, status=200):
        full = [(s, u, p, e, n, status, at, b) for s, u, p, e, n, b in rows]
        return spark.createDataFrame(full, RESPONSES)

    return build
