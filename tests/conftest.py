import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="tidemark-test-ckpt-")
    s = build_session("local[*]", 8, "tidemark-tests", {"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (selected columns, in order)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
