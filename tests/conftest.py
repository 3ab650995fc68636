import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", "millrace-tests", **{
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder(tmp_path):
    """Write {name: text or bytes} as files and return their folder."""

    def write(files: dict, sub: str = "in") -> str:
        target = tmp_path / sub
        target.mkdir(exist_ok=True)
        for name, content in files.items():
            (target / name).write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(target)

    return write


def rows(frame, *order):
    return [tuple(r) for r in (frame.orderBy(*order) if order else frame).collect()]


def column(frame, name, *order):
    return [r[0] for r in rows(frame.orderBy(*order).select(name) if order else frame.select(name))]
