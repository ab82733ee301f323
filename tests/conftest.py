import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakestrata.context import RunContext  # noqa: E402
from lakestrata.plans.medallion import Medallion  # noqa: E402
from lakestrata.session import local_session  # noqa: E402
from lakestrata.sources.frames import FrameBronze  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="lakestrata-tests")
    yield s


@pytest.fixture
def ctx():
    return RunContext.fixed()


@pytest.fixture
def medallion(spark, ctx):
    def make(frames: dict) -> Medallion:
        return Medallion(spark, FrameBronze(spark, frames), ctx)

    return make


def rows(df, *cols, order=None):
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out
