from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stellate.session import build_session, checkpoint_root  # noqa: E402

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app_name="stellate-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # a private folder: the master is local
    yield s
    s.stop()


@pytest.fixture
def tmp_text(tmp_path):
    """Write text with exact line endings and return the file path."""

    def _write(name: str, text: str) -> str:
        p = tmp_path / name
        p.write_bytes(text.encode("utf-8"))
        return str(p)

    return _write
