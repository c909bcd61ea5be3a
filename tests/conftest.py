from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from strata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    extra = {}
    s = build_session("local[*]", app="strata-tests", shuffle_partitions=8, extra=extra)
    # The shared folder comes from spark.checkpoint.dir; tests set a private one only if unset.
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="strata-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
