from __future__ import annotations

import pytest

from hirelake.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("hirelake-tests", cores=8, shuffle_partitions=4)
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield session
    session.stop()
