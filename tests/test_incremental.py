"""Change sets, and the fact that is built from them."""

import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from siltworks.operators.changes import changed_keys
from siltworks.plans import incremental, marts
from siltworks.plans.checks import CHECKS
from siltworks.plans.runs import refresh_fact, run_gold, run_silver
from siltworks.sources.store import TableStore
from plan_text import plan_of
from test_runs import CSV, DAY, NOW, raw  # noqa: F401

SCHEMA = "k string, a string, b string, _batch_id string"


def changed(spark, before, after, schema=SCHEMA, **how):
    rows = changed_keys(spark.createDataFrame(before, schema), spark.createDataFrame(after, SCHEMA), "k", **how)
    return sorted(r.k for r in rows.collect())


def test_what_counts_as_a_change(spark):
    same = [("same", "x", None, "1"), ("same", "y", "z", "1")]
    before = [
        *same, ("moved", "x", None, "1"), ("gone", "x", "y", "1"), ("fewer", "x", "y", "1"), ("fewer", "x", "y", "1"),
        ("run", "x", "y", "1"), ("swap", "x", None, "1"), (None, "x", "y", "1"),
    ]
    after = [
        *reversed(same), ("moved", None, "x", "1"), ("new", "x", "y", "1"), ("fewer", "x", "y", "1"),
        ("run", "x", "y", "2"), ("swap", None, "x", "1"), (None, "other", "y", "1"),
    ]
    wanted = ["fewer", "gone", "moved", "new", "swap"]
    assert changed(spark, before, after, ignore=("_batch_id",)) == wanted
    assert changed(spark, before, after) == sorted([*wanted, "run"])
    assert changed(spark, after, after) == changed(spark, [], []) == []


def test_a_column_more_is_a_change(spark):
    before = [("x", "a", "1")]
    assert changed(spark, before, [("x", "a", None, "1")], "k string, a string, _batch_id string") == ["x"]


def money(n):
    return f"{n}.00"


def frames(spark, rng, keys):
    orders = [(str(k), f"c{k}", "shipped", datetime(2024, 1, 1 + k % 20)) for k in keys]
    payments = [(str(k), n, rng.choice(("voucher", "boleto")), rng.randrange(90)) for k in keys for n in range(rng.randrange(3))]
    items = [(str(k), n, rng.randrange(1, 90)) for k in keys for n in range(rng.randrange(4))]
    return orders, payments, items


def as_tables(spark, orders, payments, items, run):
    marks = {"_run_date": F.lit(run), "_batch_id": F.lit(run)}
    times = {c: F.lit(None).cast("timestamp") for c in ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date")}
    return {
        "orders": spark.createDataFrame(orders, "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp").withColumns(times | marks),
        "order_payments": spark.createDataFrame(payments, "order_id string, payment_sequential int, payment_type string, payment_value int").withColumns({"payment_installments": F.lit(1), "payment_value": F.col("payment_value").cast("decimal(10,2)")} | marks),
        "order_items": spark.createDataFrame(items, "order_id string, order_item_id int, price int").withColumns({"price": F.col("price").cast("decimal(10,2)"), "freight_value": F.lit(1).cast("decimal(10,2)"), "product_id": F.lit("p"), "seller_id": F.lit("s"), "shipping_limit_date": F.lit(None).cast("timestamp")} | marks),
    }


def load(store, tables, run, **how):
    from siltworks.plans.staging import STAGING, staging

    inputs = {t: store.replace("silver", t, df, run, run).version for t, df in tables.items()}
    stored = {t: store.read("silver", t) for t in tables}
    return refresh_fact(store, {m: staging(m, stored) for m, (t, _) in STAGING.items() if t in stored}, inputs, run, run, **how)


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_full_rebuild(spark, store, tmp_path, seed):
    rng = random.Random(seed)
    orders, payments, items = frames(spark, rng, range(40))
    first = load(store, as_tables(spark, orders[:36], payments, items, "day1"), "day1")
    payments = [p if rng.random() < 0.9 else (*p[:3], p[3] + 1) for p in payments if rng.random() < 0.95]
    items = [i for i in items if rng.random() < 0.95] + [("3", 99, 7)]
    orders[5] = (*orders[5][:2], "delivered", orders[5][3])
    second = load(store, as_tables(spark, orders, payments, items, "day2"), "day2")
    whole = TableStore(spark, str(tmp_path / "whole"))
    load(whole, as_tables(spark, orders, payments, items, "day2"), "day2", refresh="full")

    def rows(of):
        return sorted(map(str, of.read("gold", "fct_orders").drop("_run_date", "_batch_id").collect()))

    assert rows(store) == rows(whole)
    ids = {r.order_id for r in store.read("ops", "changed_orders").collect()}
    marked = {r.order_id for r in store.read("gold", "fct_orders").filter("_run_date = 'day2'").collect()}
    assert ids == marked and {"3", "5", "36", "39"} <= ids and len(ids) < 40
    kept = set(first.parts) & set(second.parts)
    assert second.inputs == {t: 2 for t in incremental.SOURCES} and (kept or len(ids) > 8)

    third = load(store, as_tables(spark, orders, payments, items, "day3"), "day3")
    assert third.parts == second.parts and store.read("ops", "changed_orders").count() == 0


def test_orders_that_are_gone_stay_as_they_are(spark, store):
    rng = random.Random(9)
    orders, payments, items = frames(spark, rng, range(12))
    load(store, as_tables(spark, orders, payments, items, "day1"), "day1")
    fewer = [[r for r in rows if r[0] != "4"] for rows in (orders, payments, items)]
    load(store, as_tables(spark, *fewer, "day2"), "day2")
    assert {r.order_id for r in store.read("ops", "changed_orders").collect()} == {"4"}
    assert store.read("gold", "fct_orders").filter("order_id = '4' AND _run_date = 'day1'").count() == 1


def test_all_orders_if_a_version_is_gone(spark, store, monkeypatch):
    orders, payments, items = frames(spark, random.Random(2), range(9))
    load(store, as_tables(spark, orders, payments, items, "day1"), "day1")
    monkeypatch.setattr(store, "has_version", lambda *_: False)
    load(store, as_tables(spark, orders, payments, items, "day2"), "day2")
    assert store.read("gold", "fct_orders").filter("_run_date = 'day2'").count() == 9
    assert not store.exists("ops", "changed_orders")


def test_only_affected_orders_are_aggregated(spark, store):
    """Below each aggregate and join stands the semi join with the ids."""
    orders, payments, items = frames(spark, random.Random(3), range(30))
    tables = as_tables(spark, orders, payments, items, "day1")
    ids = spark.createDataFrame([("1",), ("2",)], "order_id string")
    rows = incremental.fact_of(ids, tables["orders"], tables["order_payments"], tables["order_items"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    for part in plan.split("Aggregate [order_id")[1:]:
        assert "LeftSemi" in part.split("\n")[1] or "LeftSemi" in part.split("\n")[2]
    whole = marts.fct_orders(tables["orders"], tables["order_payments"], tables["order_items"])
    assert sorted(map(str, rows.collect())) == sorted(map(str, whole.filter("order_id IN ('1', '2')").collect()))


def test_no_shuffle_of_clustered_tables(spark, tmp_path):
    """Fact and change set of tables clustered by order: nothing is exchanged below the fact."""
    store = TableStore(spark, str(tmp_path / "t"), {"silver": "silver_incremental_test"})
    rng = random.Random(4)
    versions = []
    for run in ("day1", "day2"):
        tables = as_tables(spark, *frames(spark, rng, range(50)), run)
        for t, df in tables.items():
            store.replace("silver", t, df, run, run, cluster=("order_id", 4))
        versions.append({t: store.read("silver", t) for t in tables})
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        new = versions[1]
        fact = marts.fct_orders(new["orders"], new["order_payments"], new["order_items"])
        assert "Exchange" not in plan_of(fact) and fact.count() == 50
        change = changed_keys(versions[0]["orders"], new["orders"], "order_id", incremental.RUN_COLUMNS)
        assert "Exchange" not in plan_of(change) and change.count() == 0
    finally:
        spark.conf.set(key, before)


def test_runs_refresh_what_has_changed(spark, tmp_path, raw):  # noqa: F811
    from siltworks.plans.runs import DATABASES, run_all, run_bronze

    store = TableStore(spark, str(tmp_path / "tables"), {k: f"{v}_incremental" for k, v in DATABASES.items()})
    run_all(store, raw(), "shop", DAY, "p", NOW)
    first = store.commit_of("gold", "fct_orders")
    assert store.commit_of("silver", "orders").clustered
    assert first.checks == {c.name: 0 for c in CHECKS["fct_orders"]}
    more = CSV["order_payments"] + "o2,2,voucher,1,5.00\n"
    run_bronze(store, raw(order_payments=more), "shop", DAY, "b2", NOW)
    run_silver(store, DAY, "s2", NOW)
    run_gold(store, DAY, "g2", NOW)
    fact = {r.order_id: r for r in store.read("gold", "fct_orders").collect()}
    assert fact["o2"].payment_count == 1 and fact["o2"]._batch_id == "s2" and fact["o1"]._batch_id != "s2"
    second = store.commit_of("gold", "fct_orders")
    assert second.checks == first.checks and len(set(first.parts) & set(second.parts)) == len(first.parts) - 1
    run_gold(store, DAY, "g3", NOW, refresh="full")
    assert {r._batch_id for r in store.read("gold", "fct_orders").collect()} == {"s2"}
    with pytest.raises(ValueError):
        run_gold(store, DAY, "g4", datetime(2024, 3, 2, tzinfo=timezone.utc), refresh="some")
