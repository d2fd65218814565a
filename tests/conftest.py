from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortflow.session import build_session, checkpoint_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", shuffle_partitions=8, app="cohortflow-tests")
    # Tests only: a scratch checkpoint folder when the session names none.
    checkpoint_dir(session, fallback=tempfile.mkdtemp(prefix="cohortflow-ckpt-"))
    yield session
    session.stop()
