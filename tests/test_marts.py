from datetime import datetime, timezone
from decimal import Decimal

from siltworks.plans import marts
from siltworks.plans.staging import STAGING, staging

NOW = datetime(2024, 3, 1, tzinfo=timezone.utc)


def orders(spark, *rows):
    return spark.createDataFrame(
        [(i, c, "delivered", *[datetime.fromisoformat(t) if t else None for t in ts], "d", "b")
         for i, c, ts in rows],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp, order_approved_at timestamp, "
        "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp, "
        "_run_date string, _batch_id string",
    )


def payments(spark, *rows):
    return spark.createDataFrame(
        [(o, t, Decimal(v)) for o, t, v in rows],
        "order_id string, payment_type string, payment_value decimal(10,2)",
    )


def items(spark, *rows):
    return spark.createDataFrame(
        [(o, p, Decimal(v), Decimal(f)) for o, p, v, f in rows],
        "order_id string, product_id string, price decimal(10,2), freight_value decimal(10,2)",
    )


def test_order_fact(spark):
    bought, due = "2017-10-02 23:00:00", "2017-10-04 01:00:00"
    fact = marts.fct_orders(
        orders(spark, ("1", "c", (bought, None, due, due)), ("2", "c", (bought, None, None, due))),
        payments(spark, ("1", "boleto", "900.00"), ("1", "voucher", "1.00")),
        items(spark, ("1", "p", "10.50", "1.00"), ("1", "q", "2.00", "0.25")),
    )
    one, two = fact.orderBy("order_id").collect()
    assert (one.item_count, one.items_total, one.freight_total) == (
        2, Decimal("12.50"), Decimal("1.25"),
    )
    assert (one.total_payment_value, one.payment_count) == (Decimal("901.00"), 2)
    assert one.primary_payment_type == "voucher"
    assert (one.delivery_days, one.delivered_on_time) == (1, True)
    assert (two.item_count, two.items_total, two.total_payment_value, two.payment_count) == (
        0, Decimal(0), Decimal(0), 0,
    )
    assert (two.primary_payment_type, two.delivery_days, two.delivered_on_time) == (
        "unknown", None, False,
    )
    types = dict(fact.dtypes)
    assert types["items_total"] == "decimal(38,2)" and types["delivery_days"] == "bigint"
    assert len(fact.columns) == 17


def test_customers(spark):
    customers = spark.createDataFrame(
        [("a", "u", 1, "x", "S"), ("b", "u", 1, "x", "S")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
        "customer_city string, customer_state string",
    )
    early, late = "2017-01-01 00:00:00", "2018-01-01 00:00:00"
    dim = marts.dim_customers(
        customers,
        orders(spark, ("1", "a", (late, None, None, None)), ("2", "a", (early, None, None, None)),
               ("3", "zz", (early, None, None, None))),
        NOW,
    )
    a, b = dim.orderBy("customer_id").collect()
    assert (a.total_orders, a.first_order_date, a.last_order_date) == (
        2, datetime(2017, 1, 1), datetime(2018, 1, 1),
    )
    assert (b.total_orders, b.first_order_date) == (0, None)
    assert a.dbt_updated_at == datetime(2024, 3, 1)
    assert len(dim.columns) == 9


def test_products(spark):
    products = spark.createDataFrame(
        [("p", "toys"), ("q", "odd"), ("r", None)], "product_id string, product_category_name string"
    ).selectExpr("*", *[f"1.0D AS product_{c}" for c in ("weight_g", "length_cm", "height_cm", "width_cm")])
    translation = spark.createDataFrame(
        [("toys", "playthings"), ("x", "y")],
        "product_category_name string, product_category_name_english string",
    )
    dim = marts.dim_products(
        products, translation, items(spark, ("1", "p", "0.01", "0"), ("2", "p", "0.02", "0")), NOW
    )
    p, q, r = dim.orderBy("product_id").collect()
    assert p.product_category_name_english == "playthings"
    assert (p.times_ordered, p.total_revenue, p.avg_price) == (2, Decimal("0.03"), Decimal("0.02"))
    assert q.product_category_name_english == "odd" and q.avg_price == 0
    assert r.product_category_name_english is None
    assert len(dim.columns) == 11


def test_hot_category_keeps_every_product(spark):
    """A third of the products share a category, another third have none.

    Without broadcasts and with thresholds fit for a small test, the hot
    partitions of the category join are split among tasks.
    """
    n = 60_000
    products = spark.range(n).selectExpr(
        "cast(id as string) AS product_id",
        "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN cast(id as string) END AS product_category_name",
        *[f"1.0D AS product_{c}" for c in ("weight_g", "length_cm", "height_cm", "width_cm")],
    )
    translation = spark.range(n).selectExpr(
        "CASE WHEN id = 0 THEN 'hot' ELSE cast(id as string) END AS product_category_name",
        "concat('en-', id) AS product_category_name_english",
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "20000",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        dim = marts.dim_products(products, translation, items(spark, ("1", "7", "1", "0")), NOW)
        names = [r[0] for r in dim.select("product_category_name_english").collect()]
        dim.collect()
        assert "skew=true" in dim._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(names) == n
    assert names.count("en-0") == n // 3 and names.count(None) == n // 3


def test_staging_keeps_listed_columns(spark):
    columns = STAGING["stg_customers"][1]
    df = spark.createDataFrame([("x",) * 6], ", ".join(f"{c} string" for c in (*columns, "_silver")))
    assert staging("stg_customers", {"customers": df}).columns == list(columns)


def test_preview_is_ordered(spark):
    fact = spark.range(50).selectExpr("cast(id + 100 as string) AS order_id")
    assert [r.order_id for r in marts.fact_preview(fact).collect()] == [str(i) for i in range(100, 110)]
