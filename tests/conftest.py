from __future__ import annotations

import pytest

from dailymart.session import local_session
from dailymart.workspace import workspace

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    return workspace(spark, SMALL)


@pytest.fixture
def plan_of():
    def text(df) -> str:
        import contextlib
        import io

        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        return out.getvalue()

    return text
