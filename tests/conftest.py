import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cohortkit.session import get_session

    s = get_session("local[*]", shuffle_partitions=8, app_name="cohortkit-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def base():
    return SMALL


def rows(df, *cols):
    """Collect selected columns as a list of tuples, in the frame's order."""
    if not cols:
        return [tuple(r) for r in df.collect()]
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]


def plan_text(df, mode: str = "formatted") -> str:
    """The text of ``df.explain(mode)`` (the final adaptive plan once ``df`` has run)."""
    import io
    from contextlib import redirect_stdout

    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
