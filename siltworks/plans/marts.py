"""Dimensions and the order fact.

Every join is a left join whose right side has one row per key, so no join
multiplies rows, and every aggregate is reduced before its shuffle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from siltworks.functions.measures import (
    TOTAL,
    elapsed_days,
    mean_money,
    moment,
    no_later_than,
    or_zero,
    total,
)


def orders_per_customer(orders: DataFrame) -> DataFrame:
    purchased = F.col("order_purchase_timestamp")
    return orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.min(purchased).alias("first_order_date"),
        F.max(purchased).alias("last_order_date"),
    )


def sales_per_product(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("times_ordered"),
        total("price").alias("total_revenue"),
        mean_money("price").alias("avg_price"),
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    """The primary type is the last one in alphabetical order, whatever its amount."""
    return payments.groupBy("order_id").agg(
        total("payment_value").alias("total_payment_value"),
        F.count(F.lit(1)).alias("payment_count"),
        F.max("payment_type").alias("primary_payment_type"),
    )


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        total("price").alias("items_total"),
        total("freight_value").alias("freight_total"),
    )


def dim_customers(
    customers: DataFrame, orders: DataFrame, as_of: datetime | Column | None = None
) -> DataFrame:
    return customers.join(orders_per_customer(orders), "customer_id", "left").select(
        *customers.columns,
        or_zero("total_orders", "bigint").alias("total_orders"),
        "first_order_date",
        "last_order_date",
        moment(as_of).alias("dbt_updated_at"),
    )


def dim_products(
    products: DataFrame,
    translation: DataFrame,
    items: DataFrame,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """The sales join comes first because products are already partitioned by their key.

    The category join, with its few and uneven keys, comes last.  It has no
    hint: Spark broadcasts the translation while its measured size allows, and
    beyond that splits the partitions of hot categories, which is safe because
    the translation has one row per category.
    """
    english = translation.select("product_category_name", "product_category_name_english")
    category = F.col("product_category_name")
    # Output names of the dimension.
    return (
        products.join(sales_per_product(items), "product_id", "left")
        .join(english, "product_category_name", "left")
        .select(
            "product_id",
            "product_category_name",
            F.coalesce("product_category_name_english", category).alias(
                "product_category_name_english"
            ),
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
            or_zero("times_ordered", "bigint").alias("times_ordered"),
            or_zero("total_revenue", TOTAL).alias("total_revenue"),
            or_zero("avg_price", "decimal(10,2)").alias("avg_price"),
            moment(as_of).alias("dbt_updated_at"),
        )
    )


def fct_orders(orders: DataFrame, payments: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order.  Both joins use the same key, so orders shuffle once.

    The output names are fixed values.
    """
    delivered, due = "order_delivered_customer_date", "order_estimated_delivery_date"
    return (
        orders.join(payments_per_order(payments), "order_id", "left")
        .join(items_per_order(items), "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            delivered,
            due,
            or_zero("item_count", "bigint").alias("item_count"),
            *[or_zero(c, TOTAL).alias(c)
              for c in ("items_total", "freight_total", "total_payment_value")],
            or_zero("payment_count", "bigint").alias("payment_count"),
            F.coalesce("primary_payment_type", F.lit("unknown")).alias("primary_payment_type"),
            elapsed_days("order_purchase_timestamp", delivered).alias("delivery_days"),
            no_later_than(delivered, due).alias("delivered_on_time"),
            "_run_date",
            "_batch_id",
        )
    )


def fact_preview(fact: DataFrame, rows: int = 10) -> DataFrame:
    """The first orders by key, for a look at the fact table."""
    return fact.orderBy("order_id").limit(rows)
