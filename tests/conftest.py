from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from siltworks.session import local_session  # noqa: E402
from siltworks.sources.store import TableStore  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
    }
    session = local_session("tests", cores=4, memory="4g", extra=folders)
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


@pytest.fixture
def texts(spark):
    """A frame of text columns: texts("a b", ("1", "2"), ...)."""

    def build(columns: str, *rows):
        schema = ", ".join(f"{c} string" for c in columns.split())
        return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)

    return build
