from __future__ import annotations

import pytest

from labelloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        "8",
        app_name="labelloom-tests",
        **{
            "spark.checkpoint.dir": shared,
            "spark.default.parallelism": "2",
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()
