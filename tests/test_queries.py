"""Every registered query against its SQL, on the smallest supplied tables."""

import pytest

from verification import queries as registered
from verification.compare import compare, connect
from verification.oracles import oracle_sql
from verification.queries import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", queries())
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, name) is None


def test_long_csv_is_written_in_parallel(spark, tmp_path, monkeypatch):
    folders = iter(range(9))
    monkeypatch.setattr(registered, "scratch", lambda _: f"{tmp_path}/{next(folders)}")
    supplied = registered.supplied
    monkeypatch.setattr(registered, "supplied", lambda *of: supplied(*of).repartition(3))
    assert registered.ingest_long_csv(spark, "/root/testdata/sf0.001").count() > 0
    assert len(list(tmp_path.glob("0/**/part-*.csv"))) == 6
