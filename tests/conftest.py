import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from terrace.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="terrace-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint folder (shared on a cluster)."""
    from terrace.session import fresh_dir

    path = fresh_dir(spark, "test")
    os.makedirs(path, exist_ok=True)
    return path


def plan_text(df, mode="formatted") -> str:
    """Text of ``df.explain(mode)``."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
