import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from finlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[8]", 8)
    s.sparkContext.setLogLevel("ERROR")
    return s


def rows(df, *cols):
    """Rows as tuples, sorted."""
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=str)
