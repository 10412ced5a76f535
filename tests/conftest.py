import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from tidemark.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(root / "checkpoint"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(frame, *order):
    """Rows as tuples, sorted."""
    frame = frame.select(*order) if order else frame
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def plan(frame) -> str:
    return frame._jdf.queryExecution().toString()
