import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from siltworks.operators.cleanse import OUTCOME
from siltworks.operators.quality import (
    ACCEPTED, EXPRESSION, NOT_NULL, UNIQUE, Check, counted_results, evaluate,
)
from siltworks.operators.upsert import upsert
from siltworks.sources.store import Conflict, TableNotFound, TableStore

RUN = ("b1", "2024-01-01")


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_versions_and_rollback(spark, store):
    first = store.replace("silver", "t", spark.range(3), *RUN)
    second = store.replace("silver", "t", store.read("silver", "t").filter("id > 0"), *RUN)
    assert (first.version, first.rows, second.version, second.rows) == (1, 3, 2, 2)
    assert ids(store.read("silver", "t")) == [1, 2]
    assert ids(store.read("silver", "t", version=1)) == [0, 1, 2]
    back = store.rollback("silver", "t", 1)
    assert (back.version, back.restores, back.path) == (3, 1, first.path)
    assert ids(store.read("silver", "t")) == [0, 1, 2]
    assert store.versions("silver", "t").count() == 3


def test_another_session_object_sees_the_tables(spark, store):
    store.replace("silver", "t", spark.range(3), *RUN)
    assert ids(TableStore(spark, store.root).read("silver", "t")) == [0, 1, 2]


def test_a_moved_store_stays_readable(spark, store, tmp_path):
    import shutil

    store.replace_split("silver", "t", tagged(spark, 10, 3), *RUN)
    shutil.copytree(store.root, tmp_path / "elsewhere")
    assert ids(TableStore(spark, str(tmp_path / "elsewhere")).read("silver", "t")) == list(range(3, 10))


def test_missing_table_and_version(spark, store):
    assert not store.exists("silver", "t")
    with pytest.raises(TableNotFound):
        store.read("silver", "t")
    store.replace("silver", "t", spark.range(3), *RUN)
    with pytest.raises(TableNotFound):
        store.read("silver", "t", version=9)


def test_failed_write_leaves_the_old_version(spark, store):
    store.replace("silver", "t", spark.range(3), *RUN)
    with pytest.raises(Exception):
        store.replace("silver", "t", spark.range(5).select(F.raise_error(F.lit("x")).alias("id")), *RUN)
    with pytest.raises(ValueError):
        store.replace("silver", "t", spark.range(0), *RUN, allow_empty=False)
    assert ids(store.read("silver", "t")) == [0, 1, 2]


def test_empty_table_keeps_its_schema(spark, store):
    commit = store.replace("silver", "t", spark.range(5).filter("id > 9"), *RUN)
    assert commit.rows == 0
    assert store.read("silver", "t").dtypes == [("id", "bigint")]


def tagged(spark, n, bad):
    outcome = F.when(F.col("id") < bad, "quarantine").otherwise("good")
    return spark.range(n).withColumns(
        {OUTCOME: outcome, "_silver_timestamp": F.lit(1), "quarantine_reason": F.lit("r"),
         "quarantined_at": F.lit(2)}
    )


@pytest.mark.parametrize("open_files", ["0", "4"])
def test_split_tables_are_written_once(spark, store, open_files):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, open_files)
    try:
        good, bad = store.replace_split("silver", "t", tagged(spark, 10, 3), *RUN)
    finally:
        spark.conf.set(key, before)
    assert (good.rows, bad.rows, good.path) == (7, 3, bad.path)
    assert store.read("silver", "t").columns == ["id", "_silver_timestamp"]
    assert ids(store.read("silver", "t")) == list(range(3, 10))
    assert store.read("silver", "quarantine_t").columns == ["id", "quarantine_reason", "quarantined_at"]
    assert ids(store.read("silver", "quarantine_t")) == [0, 1, 2]


def test_clean_rerun_empties_the_quarantine(spark, store):
    store.replace_split("silver", "t", tagged(spark, 10, 3), *RUN)
    store.replace_split("silver", "t", tagged(spark, 10, 0), *RUN)
    assert store.read("silver", "quarantine_t").count() == 0
    assert store.read("silver", "t").count() == 10
    store.replace_split("silver", "t", tagged(spark, 0, 0), *RUN)
    assert store.read("silver", "t").count() == 0


def test_one_outcome_is_read_without_the_other(spark, store):
    from plan_text import plan_of

    store.replace_split("silver", "t", tagged(spark, 10, 3), *RUN)
    assert "PartitionFilters: [isnotnull(outcome" in plan_of(store.read("silver", "t"))


def test_upsert_creates_then_merges(spark, store):
    def rows(a, b, v):
        return spark.range(a, b).withColumn("v", F.lit(v))

    store.upsert("gold", "f", rows(0, 4, "x"), ["id"], *RUN)
    store.upsert("gold", "f", rows(2, 6, "y"), ["id"], *RUN)
    got = {r.id: r.v for r in store.read("gold", "f").collect()}
    assert got == {0: "x", 1: "x", 2: "y", 3: "y", 4: "y", 5: "y"}


def test_compaction_keeps_rows_in_fewer_files(spark, store):
    from plan_text import plan_of

    store.replace("gold", "f", spark.range(1000).repartition(40), *RUN)
    assert len(store.read("gold", "f").inputFiles()) == 40
    commit = store.compact("gold", "f")
    packed = store.read("gold", "f")
    assert commit.rows == 1000 and len(packed.inputFiles()) == 1
    assert ids(packed) == list(range(1000))
    assert "Exchange" not in plan_of(packed.coalesce(1))
    assert store.compact("gold", "f") is None
    assert store.commit_of("gold", "f").version == 2


def test_compaction_aims_at_a_length(spark, store):
    wide = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 512).alias("id"))
    store.replace("gold", "f", wide.repartition(40), *RUN)
    store.compact("gold", "f", target=100_000)
    assert 4 <= len(store.read("gold", "f").inputFiles()) <= 10
    assert store.read("gold", "f").distinct().count() == 4000


def test_compaction_of_one_outcome(spark, store):
    store.replace_split("silver", "t", tagged(spark, 1000, 300).repartition(30), *RUN)
    store.compact("silver", "t")
    assert len(store.read("silver", "t").inputFiles()) == 1
    assert ids(store.read("silver", "t")) == list(range(300, 1000))
    assert ids(store.read("silver", "quarantine_t")) == list(range(300))


def test_catalog_views_follow_the_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"), {"silver": "silver_test", "gold": "gold_test"})
    store.replace_split("silver", "orders", tagged(spark, 10, 3), *RUN)
    assert spark.table("silver_test.orders").count() == 7
    assert spark.table("silver_test.quarantine_orders").count() == 3
    store.publish_projection("gold", "stg_orders", "silver", "orders", ["id"])
    store.replace_split("silver", "orders", tagged(spark, 20, 0), *RUN)
    assert spark.table("gold_test.stg_orders").count() == 20
    empty = spark.table("silver_test.quarantine_orders")
    assert empty.count() == 0 and empty.columns == ["id", "quarantine_reason", "quarantined_at"]
    store.rollback("silver", "orders", 1)
    assert spark.sql("SELECT count(*) FROM silver_test.orders").first()[0] == 7

    spark.sql("DROP VIEW silver_test.orders")
    store.publish_all("silver", ["orders", "not_there"])
    assert spark.table("silver_test.orders").count() == 7


def other(spark, store):
    return TableStore(spark, store.root)


def test_two_interleaved_upserts_keep_both_loads(spark, store):
    store.replace("gold", "f", spark.range(2).withColumn("v", F.lit("old")), "b", "d")

    def load(first, meanwhile=None):
        rows = spark.range(first, first + 2).withColumn("v", F.lit("new"))
        calls = []

        def build(now):
            if meanwhile and not calls:
                meanwhile()
            calls.append(1)
            return upsert(now, rows, ["id"])

        store.change("gold", "f", build, "b", "d")
        return len(calls)

    def faster():
        rows = spark.range(10, 12).withColumn("v", F.lit("new"))
        other(spark, store).upsert("gold", "f", rows, ["id"], "b", "d")

    assert load(20, faster) == 2
    assert ids(store.read("gold", "f")) == [0, 1, 10, 11, 20, 21]


def test_compaction_never_undoes_a_load(spark, store, monkeypatch):
    store.replace("gold", "f", spark.range(0, 100, 1, 9), "b", "d")
    write = store._write

    def write_late(*args, **kwargs):
        counts = write(*args, **kwargs)
        other(spark, store).upsert("gold", "f", spark.range(100, 102), ["id"], "b", "d")
        return counts

    monkeypatch.setattr(store, "_write", write_late)
    assert store.compact("gold", "f") is None
    assert ids(store.read("gold", "f")) == list(range(102))


def test_simultaneous_upserts(spark, store):
    store.replace("gold", "f", spark.range(1), "b", "d")

    def load(k):
        other(spark, store).upsert("gold", "f", spark.range(10 * k, 10 * k + 2), ["id"], "b", "d")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(inheritable_thread_target(spark)(load), (1, 2, 3, 4)))
    assert ids(store.read("gold", "f")) == [0, 10, 11, 20, 21, 30, 31, 40, 41]
    assert [r.version for r in store.versions("gold", "f").orderBy("version").collect()] == [1, 2, 3, 4, 5]


def test_a_lasting_conflict_is_told(spark, store):
    store.replace("gold", "f", spark.range(1), "b", "d")

    def build(now):
        other(spark, store).replace("gold", "f", spark.range(1), "b", "d")
        return now

    with pytest.raises(Conflict):
        store.change("gold", "f", build, "b", "d")


def test_reading_writes_nothing(spark, store, tmp_path):
    assert not store.exists("gold", "nothing") and store.versions("gold", "nothing").count() == 0
    assert not (tmp_path / "tables").exists()


def kept_history(store):
    def run(day, rows, columns="id long, city string"):
        source = store.spark.createDataFrame(rows, columns)
        at = datetime(2024, 1, 1) + timedelta(days=day)
        return store.keep_history("gold", "h", source, "id", ["city"], "b", "d", at)

    return run


def test_history_keeps_the_folders_of_ended_versions(spark, store):
    run = kept_history(store)
    same = [(k, "s") for k in (5, 6, 7)]
    run(1, [(1, "a"), (2, "b"), (3, "c"), *[(k, "r") for k in (5, 6, 7)]])
    second = run(2, [(1, "A"), (2, "b"), (3, "c"), *same])
    ended = [p for p in second.parts if p.endswith("_ended=true")]
    third = run(3, [(1, "A"), (2, "B"), (3, "c"), (4, "d"), *same])
    assert len(ended) == 1 and ended[0] in third.parts
    assert third.rows == store.read("gold", "h").count() == 12
    unchanged = run(3, [(1, "A"), (2, "B"), (3, "c"), (4, "d"), *same])
    assert unchanged.rows == 12
    wide = [(k, "s", "x") for k in (5, 6, 7)]
    wider = run(4, [(1, "A", "x"), (2, "b", "x"), (3, "c", "x"), (4, "d", "x"), *wide], "id long, city string, note string")
    assert wider.rows == 13 and ended[0] in wider.parts
    rows = {(r.id, r.city, r.note) for r in store.read("gold", "h").filter("dbt_valid_to IS NULL").collect()}
    assert (2, "b", "x") in rows and (1, "A", None) in rows
    with pytest.raises(Exception, match="not later"):
        run(4, [(1, "other")])
    assert store.read("gold", "h").count() == 13


def test_history_folders_grow_with_the_logarithm(spark, store):
    """32 runs, each with one change: few folders, each row once, versions that ended not read again."""
    run = kept_history(store)
    for day in range(32):
        commit = run(day, [(k, f"{k}-{max(0, day - (day - k) % 4)}" if day >= k else f"{k}-0") for k in range(4)])
        assert len(commit.parts) <= 6 and sum(commit.part_rows) == commit.rows
    rows = store.read("gold", "h")
    assert rows.count() == commit.rows > 28
    assert rows.filter("dbt_valid_to IS NULL").count() == 4
    assert rows.select("id", "dbt_valid_from").distinct().count() == commit.rows

    read = []
    opened = store._open
    store._open = lambda c, parts=None: read.extend(parts or c.parts) or opened(c, parts)
    again = run(32, [tuple(r) for r in rows.filter("dbt_valid_to IS NULL").select("id", "city").collect()])
    assert again.rows == commit.rows and not any(p.endswith("_ended=true") for p in read)
    assert [p for p in again.parts if p.endswith("=true")] == [p for p in commit.parts if p.endswith("=true")]


def test_history_is_compacted_by_kind(spark, store):
    run = kept_history(store)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run(1, [(k, "a") for k in range(200)])
        run(2, [(k, "b" if k < 150 else "a") for k in range(200)])
        third = run(3, [(k, "c" if k < 20 else "b" if k < 150 else "a") for k in range(200)])
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = sorted(map(str, store.read("gold", "h").collect()))
    packed = store.compact("gold", "h")
    assert len(packed.parts) == 2 and packed.rows == third.rows == sum(packed.part_rows)
    assert len(store.read("gold", "h").inputFiles()) == 2
    assert sorted(map(str, store.read("gold", "h").collect())) == rows
    assert max(packed.part_newest) == max(third.part_newest)
    assert store.compact("gold", "h") is None
    assert run(4, [(k, "d") for k in range(200)]).rows == third.rows + 200


# -- commits -----------------------------------------------------------------


def record(store, number, text):
    path = Path(store.root) / f"commits/gold/f/{number:020d}.json"
    path.write_text(text)


@pytest.mark.parametrize("torn", ["", '{"layer": "gold", "table"'])
def test_a_torn_record_locks_nothing(spark, store, torn):
    store.upsert("gold", "f", spark.range(2), ["id"], *RUN)
    record(store, 2, torn)
    assert ids(store.read("gold", "f")) == [0, 1]
    assert store.upsert("gold", "f", spark.range(2, 4), ["id"], *RUN).version == 3
    record(store, 4, torn)
    record(store, 5, torn)
    assert store.replace("gold", "f", spark.range(9), *RUN).version == 6
    assert [r.version for r in store.versions("gold", "f").orderBy("version").collect()] == [1, 3, 6]
    assert ids(store.read("gold", "f", version=3)) == [0, 1, 2, 3]
    with pytest.raises(TableNotFound):
        store.read("gold", "f", version=4)


def test_a_writer_that_dies_leaves_no_record(spark, store, monkeypatch):
    from siltworks.sources import shared_files

    store.replace("gold", "f", spark.range(2), *RUN)

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(shared_files, "_rename_once", dies)
        with pytest.raises(KeyboardInterrupt):
            store.replace("gold", "f", spark.range(5), *RUN)
    assert store.log.numbers("gold", "f") == [1]
    assert store.replace("gold", "f", spark.range(3), *RUN).version == 2


def test_a_record_is_created_by_one_writer_only(spark, tmp_path):
    from siltworks.sources.shared_files import create_once, names_in, read_text

    path = f"{tmp_path}/log/1.json"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(inheritable_thread_target(spark)(lambda k: create_once(spark, path, f"writer {k}")), range(24)))
    assert made.count(True) == 1
    assert read_text(spark, path) == f"writer {made.index(True)}"
    assert names_in(spark, f"{tmp_path}/log") == [".1.json.crc", "1.json"] or names_in(spark, f"{tmp_path}/log") == ["1.json"]
    assert names_in(spark, f"{tmp_path}/nowhere") == [] and read_text(spark, f"{tmp_path}/nowhere") is None


def test_names_in_a_folder_with_commas(spark, tmp_path):
    from siltworks.sources.shared_files import names_in

    folder = tmp_path / "a,b" / "c d,file:"
    folder.mkdir(parents=True)
    for name in ("1.json", "x=1", "z"):
        (folder / name).touch()
    assert names_in(spark, str(folder)) == names_in(spark, f"file://{folder}/") == ["1.json", "x=1", "z"]


def test_a_view_never_goes_back(spark, tmp_path, monkeypatch):
    """Another writer commits and publishes between a record and its publication."""
    databases = {"gold": "gold_order_test"}
    store = TableStore(spark, str(tmp_path / "t"), databases)
    rival = TableStore(spark, str(tmp_path / "t"), databases)
    store.replace("gold", "f", spark.range(1), *RUN)
    publish, calls = store._publish, []

    def late(commit):
        if not calls:
            rival.upsert("gold", "f", spark.range(100, 101), ["id"], *RUN)
        calls.append(commit.version)
        publish(commit)

    monkeypatch.setattr(store, "_publish", late)
    store.replace("gold", "f", spark.range(4), *RUN)
    assert ids(store.read("gold", "f")) == ids(spark.table("gold_order_test.f")) == [0, 1, 2, 3, 100]
    assert calls == [2, 3]


# -- upsert by folder --------------------------------------------------------


def bucket_numbers(parts):
    return {int(p.rpartition("=")[2]): p for p in parts}


def test_upsert_leaves_untouched_folders_alone(spark, store):
    rows = spark.range(2000).withColumn("v", F.lit("old"))
    first = store.upsert("gold", "f", rows, ["id"], *RUN)
    assert len(first.parts) == first.buckets == 16 and first.rows == 2000
    second = store.upsert("gold", "f", spark.createDataFrame([(7, "new"), (5000, "new")], "id long, v string"), ["id"], *RUN)
    before, after = bucket_numbers(first.parts), bucket_numbers(second.parts)
    changed = {k for k in after if after[k] != before[k]}
    assert 1 <= len(changed) <= 2 and second.rows == 2001
    got = {r.id: r.v for r in store.read("gold", "f").collect()}
    assert len(got) == 2001 and {k for k, v in got.items() if v == "new"} == {7, 5000}
    third = store.upsert("gold", "f", rows.filter("false"), ["id"], *RUN)
    assert third.parts == second.parts and third.rows == 2001 and third.version == 3
    assert store.compact("gold", "f") is None


def test_upsert_reads_only_touched_folders(spark, store):
    store.upsert("gold", "f", spark.range(1000), ["id"], *RUN)
    read, opened = [], store._open
    store._open = lambda c, parts=None: read.append(parts) or opened(c, parts)
    store.upsert("gold", "f", spark.range(1), ["id"], *RUN)
    assert [len(p) for p in read] == [1]


def test_upsert_deals_anew_when_more_folders_are_wanted(spark, store):
    store.upsert("gold", "f", spark.range(100), ["id"], *RUN, buckets=4)
    assert store.upsert("gold", "f", spark.range(100, 101), ["id"], *RUN, buckets=7).buckets == 4
    dealt = store.upsert("gold", "f", spark.range(101, 102), ["id"], *RUN, buckets=8)
    assert dealt.buckets == 8 and dealt.rows == 102 and ids(store.read("gold", "f")) == list(range(102))


def test_upsert_of_another_key_or_an_undealt_table(spark, store):
    rows = spark.range(50).withColumn("k", F.col("id") % 25)
    store.replace("gold", "f", rows, *RUN)
    first = store.upsert("gold", "f", spark.range(50, 52).withColumn("k", F.lit(1).cast("long")), ["id"], *RUN)
    assert first.rows == 52 and first.buckets == 16
    assert sorted(r.id for r in store.read("gold", "f").collect()) == list(range(52))


def test_upsert_keys_of_another_type_null_keys_and_new_columns(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"), {"gold": "gold_types_test"})
    store.upsert("gold", "f", spark.createDataFrame([(k, "a") for k in range(300)], "id long, v string"), ["id"], *RUN)
    more = spark.createDataFrame([(k, "b", True) for k in (3, 299, 400)], "id int, v string, fresh boolean")
    second = store.upsert("gold", "f", more, ["id"], *RUN)
    assert second.mixed and second.rows == 301
    got = {r.id: (r.v, r.fresh) for r in spark.table("gold_types_test.f").collect()}
    assert got[3] == got[299] == got[400] == ("b", True) and got[4] == ("a", None) and len(got) == 301
    null = spark.createDataFrame([(None, "n", None)], "id long, v string, fresh boolean")
    assert store.upsert("gold", "f", null, ["id"], *RUN).rows == 302
    with pytest.raises(Exception, match="more than one row"):
        store.upsert("gold", "f", more.unionAll(more), ["id"], *RUN)
    with pytest.raises(Exception, match="more than one row"):
        store.upsert("gold", "g", more.unionAll(more), ["id"], *RUN)


# -- packing and removal -----------------------------------------------------


def file_sizes(store, table):
    return [Path(f.removeprefix("file://")).stat().st_size for f in store.read("gold", table).inputFiles()]


def test_compaction_packs_by_length(spark, store):
    """Very uneven files: two thirds of the rows in one, the rest in sixty."""
    wide = spark.range(6000).select(F.sha2(F.col("id").cast("string"), 512).alias("id"))
    spark.conf.set("parquet.block.size", str(32 << 10))
    big = wide.limit(4000).coalesce(1).unionAll(wide.subtract(wide.limit(4000)).repartition(60))
    store.replace("gold", "f", big, *RUN)
    before = file_sizes(store, "f")
    target = 60_000
    store.compact("gold", "f", target=target)
    after = file_sizes(store, "f")
    assert max(before) > 4 * target and len(before) > 40
    assert max(after) <= 1.5 * target and len(after) <= 2 * sum(after) / target + 1
    assert store.read("gold", "f").distinct().count() == 6000


def test_compaction_of_crowded_folders_only(spark, store):
    first = store.upsert("gold", "f", spark.range(3000), ["id"], *RUN, buckets=4)
    folder = Path(store.root) / bucket_numbers(first.parts)[2]
    spark.read.parquet(str(folder)).repartition(12).write.mode("append").parquet(str(folder))
    small = [p for p in folder.glob("*.parquet")]
    for p in sorted(small, key=lambda p: p.stat().st_size)[-1:]:
        p.unlink()  # the file that the twelve repeat
    packed = store.compact("gold", "f")
    before, after = bucket_numbers(first.parts), bucket_numbers(packed.parts)
    assert {k for k in after if after[k] != before[k]} == {2}
    assert ids(store.read("gold", "f")) == list(range(3000))


def test_expired_versions_and_lost_attempts_go(spark, store):
    def age(path, at):
        for p in [path, *path.rglob("*")]:
            os.utime(p, (at, at))

    root = Path(store.root)
    for n in range(1, 6):
        store.replace_split("silver", "t", tagged(spark, 10 + n, n), *RUN)
    store.upsert("silver", "u", spark.range(40), ["id"], *RUN)
    for n in range(3):
        last = store.upsert("silver", "u", spark.range(n, n + 1), ["id"], *RUN)
    store.rollback("silver", "t", 1)
    lost, dying = root / "silver/t" / ("a" * 32), root / "silver/t" / ("b" * 32)
    spark.range(3).write.parquet(str(lost))
    (dying / "_temporary/0/x").mkdir(parents=True)
    spark.range(3).write.parquet(str(root / "silver/t" / ("c" * 32)))  # a writer at work
    later = datetime.now(timezone.utc) + timedelta(days=2)
    for folder in root.glob("silver/*/*"):
        age(folder, later.timestamp() if folder.name == "c" * 32 else 0)
    gone = store.expire("silver", keep=2, younger_than=timedelta(days=1), now=later)
    assert lost.name in {g.rpartition("/")[2] for g in gone} and dying.name in {g.rpartition("/")[2] for g in gone}
    assert not lost.exists() and not dying.exists()
    assert store.log.numbers("silver", "t") == [5, 6] and store.log.numbers("silver", "u") == [3, 4]
    assert ids(store.read("silver", "t")) == list(range(1, 11)) and ids(store.read("silver", "t", version=5)) == list(range(5, 15))
    assert ids(store.read("silver", "quarantine_t")) == list(range(5))
    assert ids(store.read("silver", "quarantine_t", version=4)) == list(range(4))
    assert ids(store.read("silver", "u")) == list(range(40)) and last.parts
    assert ids(store.read("silver", "u", version=3)) == list(range(40))
    with pytest.raises(TableNotFound):
        store.read("silver", "t", version=1)
    assert (root / "silver/t" / ("c" * 32)).exists()
    assert store.expire("silver", keep=2, younger_than=timedelta(days=1), now=later) == []
    assert store.expire("nothing") == []


def test_young_versions_stay(spark, store):
    for n in range(4):
        store.replace("silver", "t", spark.range(n), *RUN)
    assert store.expire("silver", keep=1) == []
    assert ids(store.read("silver", "t", version=3)) == [0, 1]


# -- checks and clusters -----------------------------------------------------


def test_checks_are_counted_by_the_write(spark, store):
    checks = (Check("k", NOT_NULL), Check("k", UNIQUE), Check("v", ACCEPTED, allowed=("a",)), Check("n", EXPRESSION, expression=">= 2"))
    rows = spark.createDataFrame(
        [("x", "a", 1), ("x", "b", 2), ("x", None, 3), ("y", "c", None), (None, "a", 5), (None, "a", 5), ("z", "a", 1)],
        "k string, v string, n int",
    )
    commit = store.replace("gold", "f", rows, *RUN, checks=checks)
    counted = counted_results(spark, {"f": (checks, commit.checks)})
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, evaluate("f", rows, checks).collect()))
    assert store.read("gold", "f").columns == ["k", "v", "n"]
    assert store.commit_of("gold", "f").checks == commit.checks
    good, bad = store.replace_split("silver", "t", tagged(spark, 10, 3), *RUN, checks=(Check("id", EXPRESSION, expression="> 4"),))
    assert good.checks == {"id expression_is_true(> 4)": 2} and bad.checks is None


def test_clustered_tables_join_without_a_shuffle(spark, tmp_path):
    from plan_text import plan_of

    store = TableStore(spark, str(tmp_path / "t"), {"silver": "silver_cluster_test"})
    store.replace_split("silver", "a", tagged(spark, 1000, 30), *RUN, cluster=("id", 4))
    store.replace("silver", "b", spark.range(2000).withColumn("v", F.col("id") % 7), *RUN, cluster=("id", 4))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        a, b = store.read("silver", "a"), store.read("silver", "b")
        both = a.join(b.groupBy("id").count(), "id", "left")
        assert "Exchange" not in plan_of(both) and both.count() == 970
    finally:
        spark.conf.set(key, before)
    assert ids(store.read("silver", "quarantine_a")) == list(range(30))
    assert spark.table("silver_cluster_test.a").count() == 970
    # A session or store that does not know the catalog table reads the files.
    name = store.commit_of("silver", "a").clustered
    spark.sql(f"DROP TABLE {name}")
    assert ids(store.read("silver", "a")) == list(range(30, 1000))
    empty, _ = store.replace_split("silver", "a", tagged(spark, 5, 5), *RUN, cluster=("id", 4))
    assert empty.clustered is None and store.read("silver", "a").count() == 0
    plain = TableStore(spark, str(tmp_path / "p"))
    assert plain.replace("silver", "b", spark.range(9), *RUN, cluster=("id", 4)).clustered is None
