import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from siltworks.operators import ledger
from siltworks.operators.history import VERSION_ID, as_known_at, history_changes, merge_history
from siltworks.operators.upsert import upsert


def kv(spark, rows, schema="k string, v string"):
    return spark.createDataFrame(rows, schema)


def as_dict(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_update_insert_keep(spark):
    merged = upsert(kv(spark, [("a", "1"), ("b", "1")]), kv(spark, [("b", None), ("c", "2")]), ["k"])
    assert as_dict(merged) == {"a": ("1",), "b": (None,), "c": ("2",)}


def test_twice_is_once(spark):
    target, source = kv(spark, [("a", "1"), ("b", "1")]), kv(spark, [("b", "2"), ("c", "2")])
    once = upsert(target, source, ["k"])
    assert as_dict(upsert(once, source, ["k"])) == as_dict(once)


def test_duplicate_source_key_fails(spark):
    with pytest.raises(Exception, match="more than one row for a key"):
        upsert(kv(spark, [("a", "1")]), kv(spark, [("b", "1"), ("b", "2")]), ["k"]).collect()


def test_new_and_missing_columns(spark):
    target = kv(spark, [("a", "1", 7), ("b", "1", 8)], "k string, v string, kept int")
    source = kv(spark, [("b", "2", True), ("c", "2", False)], "k string, v string, fresh boolean")
    merged = upsert(target, source, ["k"])
    assert merged.columns == ["k", "v", "kept", "fresh"]
    assert as_dict(merged) == {
        "a": ("1", 7, None), "b": ("2", 8, True), "c": ("2", None, False),
    }


def test_two_part_key(spark):
    schema = "k string, n int, v string"
    merged = upsert(
        kv(spark, [("a", 1, "x"), ("a", 2, "x")], schema), kv(spark, [("a", 2, "y")], schema), ["k", "n"]
    )
    assert sorted(tuple(r) for r in merged.collect()) == [("a", 1, "x"), ("a", 2, "y")]


T = [datetime(2024, m, 1, tzinfo=timezone.utc) for m in range(1, 9)]


def people(spark, **rows):
    return spark.createDataFrame(
        [(k, *v) for k, v in rows.items()], "id string, uid string, city string, zip int"
    )


def run(spark, *snapshots):
    history = None
    for at, snap in zip(T, snapshots):
        history = merge_history(history, people(spark, **snap), "id", ["city", "zip"], at)
    return history


def versions(history, key):
    rows = history.filter(F.col("id") == key).orderBy("dbt_valid_from").collect()
    return [(r.city, r.dbt_valid_from.month, r.dbt_valid_to and r.dbt_valid_to.month) for r in rows]


def test_history_cases(spark):
    history = run(
        spark,
        {"same": ("u", "x", 1), "moved": ("u", "x", 1), "filled": ("u", None, 1),
         "uid": ("u", "x", 1), "gone": ("u", "x", 1), "back": ("u", "x", 1)},
        {"same": ("u", "x", 1), "moved": ("u", "y", 1), "filled": ("u", "z", 1),
         "uid": ("other", "x", 1)},
        {"same": ("u", "x", 1), "moved": ("u", "y", 1), "filled": ("u", "z", 1),
         "uid": ("other", "x", 1), "back": ("u", "x", 1), "new": ("u", "n", 1)},
    )
    assert versions(history, "same") == [("x", 1, None)]
    assert versions(history, "moved") == [("x", 1, 2), ("y", 2, None)]
    assert versions(history, "filled") == [(None, 1, 2), ("z", 2, None)]
    assert versions(history, "uid") == [("x", 1, None)]
    assert history.filter("id = 'uid'").first().uid == "u"
    assert versions(history, "gone") == [("x", 1, 2)]
    assert versions(history, "back") == [("x", 1, 2), ("x", 3, None)]
    assert versions(history, "new") == [("n", 3, None)]
    assert history.select("dbt_scd_id").distinct().count() == history.count()


def test_missing_keys_can_stay_open(spark):
    first = merge_history(None, people(spark, a=("u", "x", 1)), "id", ["city"], T[0])
    kept = merge_history(first, people(spark, b=("u", "x", 1)), "id", ["city"], T[1], close_missing=False)
    assert kept.filter("dbt_valid_to IS NULL").count() == 2


def test_as_known_at_borders(spark):
    history = run(spark, {"a": ("u", "x", 1)}, {"a": ("u", "y", 1)})
    city = lambda at: [r.city for r in as_known_at(history, at).collect()]
    assert city(T[0] - timedelta(days=1)) == []
    assert city(T[0]) == ["x"]
    assert city(T[1]) == ["y"]
    assert city(T[5]) == ["y"]


def test_history_against_brute_force(spark):
    random.seed(11)
    snapshots = [
        {f"k{i}": ("u", random.choice(["x", "y", None]), random.choice([1, 2, None]))
         for i in range(25) if random.random() < 0.7}
        for _ in range(5)
    ]
    history = run(spark, *snapshots)

    expected, current = [], {}
    for at, snap in zip(T, snapshots):
        for key in list(current):
            if key not in snap or current[key][1][1:] != snap[key][1:]:
                start, row = current.pop(key)
                expected.append((key, row[1], row[2], start.month, at.month))
        for key, row in snap.items():
            current.setdefault(key, (at, row))
    expected += [(k, row[1], row[2], start.month, None) for k, (start, row) in current.items()]

    actual = [
        (r.id, r.city, r.zip, r.dbt_valid_from.month, r.dbt_valid_to and r.dbt_valid_to.month)
        for r in history.collect()
    ]
    assert sorted(actual, key=str) == sorted(expected, key=str)
    assert history.filter("dbt_valid_to IS NULL").groupBy("id").count().filter("count > 1").count() == 0


def test_merged_changes_give_the_same_history(spark):
    random.seed(3)
    snapshots = [
        {f"k{i}": ("u", random.choice(["x", "y", None]), 1) for i in range(30) if random.random() < 0.8}
        for _ in range(4)
    ]
    before, last = run(spark, *snapshots[:3]), people(spark, **snapshots[3])
    args = (last, "id", ["city", "zip"], T[3])
    changes = history_changes(before, *args)
    whole = merge_history(before, *args)
    merged = upsert(before, changes, [VERSION_ID])
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.select(*merged.columns).collect()))
    assert 0 < changes.count() < whole.count()


def test_ledger_last_write_wins(spark):
    def records(*rows):
        return spark.createDataFrame([("p", *r) for r in rows], ledger.SCHEMA)

    book = ledger.last_per_run(
        records(("d1", "FAILED", "e1", "2024-01-01T01"), ("d1", "SUCCEEDED", "e2", "2024-01-01T02"))
    )
    book = ledger.record(
        book, records(("d1", "FAILED", "e3", "2024-01-01T03"), ("d2", "SUCCEEDED", "e4", "2024-01-02T01"))
    )
    assert {r.run_date: (r.status, r.execution_arn) for r in book.collect()} == {
        "d1": ("FAILED", "e3"), "d2": ("SUCCEEDED", "e4"),
    }


def test_history_keeps_lost_columns_and_takes_new_ones(spark):
    first = spark.createDataFrame([(1, "a", "n1"), (2, "b", "n2")], "id long, city string, note string")
    history = merge_history(None, first, "id", ["city"], datetime(2024, 1, 1))
    without = spark.createDataFrame([(1, "A"), (2, "b")], "id long, city string")
    lost = merge_history(history, without, "id", ["city"], datetime(2024, 1, 2))
    assert {(r.id, r.city, r.note) for r in lost.collect()} == {
        (1, "a", "n1"), (1, "A", None), (2, "b", "n2")
    }
    wider = spark.createDataFrame([(1, "B", "x"), (2, "b", "x")], "id long, city string, extra string")
    gained = merge_history(lost, wider, "id", ["city"], datetime(2024, 1, 3))
    assert {(r.id, r.city, r.note, r.extra) for r in gained.collect()} == {
        (1, "a", "n1", None), (1, "A", None, None), (1, "B", None, "x"), (2, "b", "n2", None)
    }


@pytest.mark.parametrize("day", [1, 2])
def test_history_refuses_a_time_that_is_not_later(spark, day):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, city string")
    history = merge_history(None, rows, "id", ["city"], datetime(2024, 1, 2))
    changed = spark.createDataFrame([(1, "A"), (2, "b")], "id long, city string")
    for source in (changed, rows.filter("id = 1"), rows.unionByName(spark.createDataFrame([(3, "c")], rows.schema))):
        with pytest.raises(Exception, match="not later"):
            merge_history(history, source, "id", ["city"], datetime(2024, 1, day)).collect()
    same = merge_history(history, rows, "id", ["city"], datetime(2024, 1, day))
    assert same.exceptAll(history).count() == 0 and same.count() == 2
