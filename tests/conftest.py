from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from checks.compare import local_session

    session = local_session("*")
    # the frames here are tiny: few partitions, and no time spent on compiling each plan
    session.conf.set("spark.sql.shuffle.partitions", "3")
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
