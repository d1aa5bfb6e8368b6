import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from strata.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="strata-tests")
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as sorted tuples (order-insensitive comparison)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out


def plan_text(df, mode="formatted"):
    """The physical plan as ``explain`` prints it."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
