from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import local_session  # noqa: E402
from tidemark.streaming.events import ROCKSDB  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, spark__sql__streaming__stateStore__providerClass=ROCKSDB)
    yield session
    session.stop()


@pytest.fixture()
def folder():
    """A fresh scratch folder per test."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
