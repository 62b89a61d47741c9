from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

from siltworks.plans.runs import (
    DATABASES, StageFailed, record_run, results_frame, run_all, run_bronze, run_gold, run_silver,
    source_freshness,
)
from siltworks.sources.store import TableStore
from siltworks.specs import TABLES
from verification import queries

DAY = "2024-03-01"
NOW = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)

CSV = {
    "orders": (
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,2017-10-04 19:55:00,"
        "2017-10-10 21:25:13,2017-10-18 00:00:00\n"
        "o2,c2,Shipped ,2018-07-24 20:41:37,,,,2018-08-13 00:00:00\n"
        "o3,c1,lost,2018-07-24 20:41:37,,,,\n"
    ),
    "customers": (
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,14409,Franca,SP\nc2,u2,09790, sao bernardo ,SP\nc2,u2,09790, sao bernardo ,SP\n"
    ),
    "products": (
        "product_id,product_category_name,product_name_lenght,product_description_lenght,"
        "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
        "p1,perfumaria,40.0,287,1,225,16,10,14\np2,,,,,,,,\n"
    ),
    "order_items": (
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2017-10-06 11:07:15,29.99,8.72\no1,2,p1,s1,2017-10-06 11:07:15,0,8.72\n"
    ),
    "order_payments": (
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1,credit_card,1,18.12\no1,2,voucher,1,2.00\no2,1,cash,1,9.00\n"
    ),
    "order_reviews": (
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,4,,"good\n""really""",2017-10-11 00:00:00,2017-10-12 03:43:48\nr2,o2,9,,,,\n'
    ),
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,13023,campinas,SP\n",
    "geolocation": (
        "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,"
        "geolocation_state\n1037,-23.5,-46.6,sao paulo,SP\n1037,-23.5,-46.6,são paulo,SP\n"
        "1037,91,-46.6,x,SP\n"
    ),
    "product_category_name_translation": (
        "product_category_name,product_category_name_english\nperfumaria,perfumery\n"
    ),
}


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw" / f"run_date={DAY}"
    folder.mkdir(parents=True)

    def write(**changed):
        for name, text in {**CSV, **changed}.items():
            (folder / f"shop_{name}_dataset.csv").write_text(text, encoding="utf-8")
        return str(tmp_path / "raw")

    return write


def by_table(results):
    return {(r.layer, r.table_name): r for r in results}


def test_whole_run(spark, tmp_path, raw):
    store = TableStore(spark, str(tmp_path / "tables"), {k: f"{v}_run" for k, v in DATABASES.items()})
    results = by_table(run_all(store, raw(), "shop", DAY, "shop_tables", NOW))
    assert all(r.status == "succeeded" for r in results.values())
    assert results["bronze", "customers"].row_count == 3
    assert results["silver", "customers"].row_count == 2
    quarantined = {t: r.quarantined for (layer, t), r in results.items() if layer == "silver"}
    assert {t: n for t, n in quarantined.items() if n is not None} == {
        "orders": 1, "order_items": 1, "order_payments": 1, "order_reviews": 1,
    }
    fact = {r.order_id: r for r in spark.table("gold_db_run.fct_orders").collect()}
    assert set(fact) == {"o1", "o2"}
    assert (fact["o1"].item_count, fact["o1"].payment_count) == (1, 2)
    assert (fact["o1"].primary_payment_type, fact["o1"].delivery_days) == ("voucher", 8)
    assert fact["o1"].delivered_on_time is True and fact["o2"].delivered_on_time is False
    assert fact["o1"]._run_date == DAY
    assert store.read("silver", "order_reviews").first().review_comment_message == 'good\n"really"'
    names = {r.product_id: r.product_category_name_english for r in store.read("gold", "dim_products").collect()}
    assert names == {"p1": "perfumery", "p2": None}
    assert spark.table("gold_db_run.stg_customers").count() == 2
    assert store.read("gold", "dim_customers_snapshot").filter("dbt_valid_to IS NULL").count() == 2
    run = store.read("ops", "run_ledger").first()
    assert (run.pipeline_name, run.run_date, run.status) == ("shop_tables", DAY, "SUCCEEDED")

    age = source_freshness(store, NOW + timedelta(hours=30))
    assert {r.source: r.status for r in age.collect()} == {
        t: "pass" if t in ("geolocation", "product_category_name_translation") else "warn" for t in TABLES
    }


def test_rerun_changes_nothing_but_versions(spark, store, raw):
    root = raw()
    for _ in range(2):
        results = by_table(run_all(store, root, "shop", DAY, "shop_tables", NOW))
    assert results["gold", "fct_orders"].row_count == 2
    assert results["gold", "dim_customers_snapshot"].row_count == 2
    assert store.commit_of("gold", "fct_orders").version == 2
    assert store.read("ops", "run_ledger").count() == 1


def test_partial_extract_keeps_facts_and_closes_customers(spark, store, raw):
    run_all(store, raw(), "shop", DAY, "shop_tables", NOW)
    fewer = {
        "orders": "\n".join(CSV["orders"].split("\n")[:2]) + "\n",
        "customers": CSV["customers"].split("c2")[0],
    }
    run_all(store, raw(**fewer), "shop", DAY, "shop_tables", NOW + timedelta(days=1))
    assert store.read("gold", "fct_orders").count() == 2
    assert store.read("gold", "dim_customers").count() == 1
    closed = store.read("gold", "dim_customers_snapshot").filter("dbt_valid_to IS NOT NULL")
    assert [r.customer_id for r in closed.collect()] == ["c2"]
    assert store.read("silver", "quarantine_orders").count() == 0


def test_one_bad_extract_does_not_stop_the_others(spark, store, raw):
    root = raw(sellers="id,seller_city\n1,x\n", products=CSV["products"].split("\n")[0] + "\n")
    with pytest.raises(StageFailed) as failed:
        run_bronze(store, root, "shop", DAY)
    results = by_table(failed.value.results)
    assert results["bronze", "sellers"].status == "failed"
    assert "seller_id" in results["bronze", "sellers"].error
    assert results["bronze", "products"].status == "failed"
    assert sum(r.status == "succeeded" for r in results.values()) == 7
    assert store.read("bronze", "orders").count() == 3
    assert not store.exists("bronze", "products")
    report = results_frame(spark, failed.value.results)
    assert report.filter("status = 'failed'").count() == 2

    with pytest.raises(StageFailed) as failed:
        run_silver(store, DAY)
    assert {r.table_name for r in failed.value.results if r.status == "failed"} == {"sellers", "products"}


def test_failing_staging_check_blocks_dependents(spark, store, raw):
    """A missing freight value passes the cleaning but not the checks."""
    root = raw(order_items=CSV["order_items"].replace("29.99,8.72", "29.99,"))
    run_bronze(store, root, "shop", DAY)
    run_silver(store, DAY)
    with pytest.raises(StageFailed) as failed:
        run_gold(store, DAY, as_of=NOW)
    status = {r.table_name: r.status for r in failed.value.results}
    assert status == {
        "dim_customers": "succeeded", "dim_customers_snapshot": "succeeded",
        "dim_products": "skipped", "fct_orders": "skipped",
    }
    assert not store.exists("gold", "fct_orders")


def test_failed_run_is_recorded(spark, store, raw):
    with pytest.raises(StageFailed):
        run_all(store, raw(sellers="id\n1\n"), "shop", DAY, "shop_tables", NOW)
    assert store.read("ops", "run_ledger").first().status == "FAILED"
    record_run(store, "shop_tables", DAY, "SUCCEEDED", "e", NOW)
    assert [r.status for r in store.read("ops", "run_ledger").collect()] == ["SUCCEEDED"]


def test_missing_run_date_fails_every_table(spark, store, raw):
    with pytest.raises(StageFailed) as failed:
        run_bronze(store, raw(), "shop", "1999-01-01")
    assert {r.status for r in failed.value.results} == {"failed"}


def test_landed_extracts_go_on_request_and_others_stay(spark, store, raw):
    root = raw(sellers="id,seller_city\n1,x\n")
    with pytest.raises(StageFailed):
        run_bronze(store, root, "shop", DAY, drop_landed=True)
    left = {p.name for p in Path(root).glob("*/*") if p.suffix == ".csv"}
    assert left == {"shop_sellers_dataset.csv"}
    assert store.read("bronze", "order_reviews").count() == 2

    again = raw()
    run_bronze(store, again, "shop", DAY)
    assert len(list(Path(again).glob("*/*.csv"))) == len(TABLES)


@pytest.mark.parametrize("name", ["published_views", "gate_results", "stored_fct_orders", "table_results"])
def test_whole_runs_keep_their_tables_and_not_the_extracts(spark, tmp_path, raw, monkeypatch, name):
    """Extracts are as long as all that is made of them; they are in the way once they have landed."""
    folder = f"{raw()}/run_date={DAY}"

    def extract(spark, sf_dir, table):
        return spark.read.csv(f"{folder}/shop_{table}_dataset.csv", header=True, escape='"', multiLine=True)

    monkeypatch.setattr(queries, "extract", extract)
    monkeypatch.setattr(queries, "scratch", lambda _: f"file://{tmp_path}/kept")
    rows = queries.queries()[name](spark, "none").collect()
    kept = tmp_path / "kept"
    tables = ["orders", "order_items", "order_payments", "customers", "products", "order_reviews"]
    assert all(list((kept / "tables" / layer / t).rglob("*.parquet")) for t in tables for layer in ("bronze", "silver"))
    left = {p.parent.name for p in (kept / "raw").rglob("part-*")}
    # An empty extract and one without its key column do not land.
    stay = {"shop_sellers_dataset.csv", "shop_geolocation_dataset.csv"} if name == "gate_results" else set()
    assert left == stay
    if name == "stored_fct_orders":
        assert {(r.order_id, r.item_count, r.payment_count) for r in rows} == {("o1", 1, 2), ("o2", 0, 0)}
    elif name == "published_views":
        assert {(r.layer, r.row_count) for r in rows if r.view_name == "customers"} == {("bronze", 3), ("silver", 2)}
    else:
        assert {r.layer for r in rows} == {"bronze", "silver", "gold"}
