import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_session

    ckpt = tempfile.mkdtemp(prefix="strata-test-ckpt-")
    session = get_session(
        app_name="strata-tests",
        master="local[*]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": ckpt, "spark.ui.enabled": "false",
              "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="strata-test-wh-")},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def plan_text(df, mode="formatted") -> str:
    """The physical plan as printed by ``explain``."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="strata-test-")
