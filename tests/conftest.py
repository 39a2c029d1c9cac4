import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = os.environ.get("TILLBOOK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tillbook.session import local_session
    s = local_session(4, shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tillbook.session import scratch_dir
    return scratch_dir(spark, "test")


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def write_csv(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
