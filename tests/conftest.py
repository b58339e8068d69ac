import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terrapipe.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session("terrapipe-tests", master="local[*]",
                          conf={"spark.sql.shuffle.partitions": "8"})
    yield session
    session.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


def write_text(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="terrapipe-test-")


def plan_text(df, mode="formatted"):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
