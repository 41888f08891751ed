import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as a list of dicts (sorted by ``order`` when given)."""
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[k] is None, r[k]) for k in order))
    return out
