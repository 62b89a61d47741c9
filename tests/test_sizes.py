"""What keeps the work of a query, and the memory of its tasks, in step with its tables."""

from __future__ import annotations

import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siltworks import session
from siltworks.sources import store as stores
from siltworks.sources.store import TableStore
from verification import queries

from plan_text import plan_of

SPLIT, WRITERS = "spark.sql.files.maxPartitionBytes", "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def settings(spark):
    """The two settings, put back afterwards."""
    before = {name: spark.conf.get(name) for name in (SPLIT, WRITERS)}
    yield spark.conf
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def tables(spark, tmp_path):
    orders = spark.range(1, 40).selectExpr(
        "id o_orderkey", "id % 7 o_custkey", "if(id % 2 = 0, 'F', 'O') o_orderstatus",
        "timestamp_ntz '1998-03-04 00:00:00' o_orderdate",
    )
    lines = spark.range(1, 120).selectExpr(
        "id % 40 l_orderkey", "cast(id div 40 + 1 as int) l_linenumber", "id % 11 l_partkey", "id % 5 l_suppkey",
        "timestamp_ntz '1998-03-09 00:00:00' l_shipdate", "cast(id * 1.25 as double) l_extendedprice",
        "cast(id % 9 + 1 as double) l_quantity", "if(id % 3 = 0, 'A', 'N') l_returnflag",
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_queries_read_small_splits_and_do_not_sort_their_writes(spark, settings, tables):
    settings.set(SPLIT, "128m")
    settings.set(WRITERS, "0")
    queries.queries()["silver_payments"](spark, tables)
    assert int(settings.get(SPLIT)) == session.SPLIT_BYTES <= 16 << 20
    assert settings.get(WRITERS) == session.SETTINGS[WRITERS] != "0"


def test_lower_limits_stay(spark, settings):
    settings.set(SPLIT, "1m")
    settings.set(WRITERS, "9")
    session.limit_tasks(spark)
    assert (settings.get(SPLIT), settings.get(WRITERS)) == ("1m", "9")


def test_sources_of_the_refreshed_fact_are_cleaned_once(spark, tables, monkeypatch):
    """Both days read what was written, not the supplied tables."""
    read, write = [], TableStore.replace

    def spy(self, layer, table, df, *args, **more):
        if layer == "silver":
            read.extend(df.inputFiles())
        return write(self, layer, table, df, *args, **more)

    monkeypatch.setattr(TableStore, "replace", spy)
    assert queries.queries()["fct_orders_incremental"](spark, tables).count() > 20
    assert read and not [f for f in read if f"{tables}/" in f]


def test_clusters_follow_the_rows(spark, tables, monkeypatch):
    """As many files as the stages would choose for so many rows."""
    asked, used, write = [], [], TableStore.replace_split

    def number(rows):
        asked.append(rows)
        return 16

    def spy(self, *args, **more):
        used.append(more["cluster"][1])
        return write(self, *args, **more)

    monkeypatch.setattr(queries, "files_for", number)
    monkeypatch.setattr(TableStore, "replace_split", spy)
    assert queries.queries()["fct_orders_clustered"](spark, tables).count() > 20
    assert asked == [119] and used == [16, 16, 16]


def test_extracts_are_written_side_by_side(spark, monkeypatch):
    """All of them; one that fails is not passed over."""
    written = []

    def write(df, path):
        if "sellers" in path:
            raise ValueError("no room")
        written.append(path)

    monkeypatch.setattr(queries, "extract", lambda *args: None)
    monkeypatch.setattr(queries, "write_csv", write)
    with pytest.raises(ValueError, match="no room"):
        queries.write_extracts(spark, "none", "/root-of-raw", "2024-03-01")
    assert len(written) == len(queries.TABLES) - 1


def test_upserts_shuffle_each_side_once_and_their_tasks_follow_the_rows(spark, tmp_path, monkeypatch):
    """What a task joins belongs to one folder, so nothing is dealt to folders by a second shuffle."""
    plans, write = [], TableStore._write

    def spy(self, rows, *args, **more):
        plans.append(plan_of(rows))
        return write(self, rows, *args, **more)

    monkeypatch.setattr(TableStore, "_write", spy)
    monkeypatch.setattr(stores, "TASK_ROWS", 100, raising=False)
    store = TableStore(spark, str(tmp_path / "tables"))
    rows = spark.range(4000).selectExpr("cast(id as string) k", "id v")
    for n, part in enumerate((rows.filter("v < 3000"), rows.filter("v >= 2000").selectExpr("k", "-v v"))):
        store.upsert("gold", "t", part, ["k"], f"run-{n}", "2024-03-01", buckets=4)
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 2]
    assert not [p for p in plans if "REBALANCE" in p.upper()]
    found = {r.k: r.v for r in store.read("gold", "t").collect()}
    assert found == {str(v): -v if v >= 2000 else v for v in range(4000)}
    folders = sorted((tmp_path / "tables").glob("gold/t/*/_bucket=*"))
    files = {f: len(list(f.glob("*.parquet"))) for f in folders}
    # Tasks for 3000 rows, then for those and 2000 more, as many in each of 4 folders.
    assert sorted(files.values()) == [8] * 4 + [13] * 4


REMOVAL = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {str(f) for top in manager.localDirsString() for f in Path(top).rglob("shuffle_*")}


@pytest.mark.parametrize("how", ["replace", "clustered", "upsert"])
def test_writes_leave_no_shuffle_files(spark, tmp_path, how):
    """Neither the joins and aggregates written nor the keys that an upsert reads first."""
    store = TableStore(spark, str(tmp_path / "tables"), {"silver": f"silver_{how}"})
    rows = spark.range(4000).selectExpr("cast(id % 1500 as string) k", "id v").groupBy("k").agg(F.sum("v").alias("v"))
    before = shuffle_files(spark)
    if how == "upsert":
        store.upsert("silver", "t", rows, ["k"], "run", "2024-03-01", buckets=4)
    else:
        cluster = ("k", 4) if how == "clustered" else None
        store.replace("silver", "t", rows, "run", "2024-03-01", cluster=cluster)
    until = time.time() + 10  # they are removed in the background
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert store.read("silver", "t").count() == 1500


def test_shuffles_outside_of_writes_stay(spark):
    """The setting holds while any thread writes; what one frame shuffles can be read twice under it."""
    before, inside, leave = spark.conf.get(REMOVAL, None), threading.Event(), threading.Event()

    def other():
        with session.shuffles_removed(spark):
            inside.set()
            leave.wait(20)

    thread = threading.Thread(target=other)
    with session.shuffles_removed(spark):
        thread.start()
        assert inside.wait(20)
        rows = spark.range(100).selectExpr("id % 7 k").groupBy("k").count()
        assert rows.count() == 7 and sorted(rows.collect()) == sorted(rows.collect())
    assert spark.conf.get(REMOVAL) == "true"
    leave.set()
    thread.join()
    assert spark.conf.get(REMOVAL, None) == before

    with pytest.raises(ValueError), session.shuffles_removed(spark):
        raise ValueError
    assert spark.conf.get(REMOVAL, None) == before
