from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from caseload.session import spark_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = spark_session("local[*]", 8, app_name="caseload-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small() -> str:
    return SF_SMALL


def rows(df, order=None):
    """Collected rows as sorted tuples (columns sorted by name unless ``order`` is given)."""
    cols = order or sorted(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
