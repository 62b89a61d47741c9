"""Narrow projections over the cleaned tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# Staging model -> (cleaned table, columns kept).
STAGING: dict[str, tuple[str, tuple[str, ...]]] = {
    "stg_orders": (
        "orders",
        (
            "order_id", "customer_id", "order_status",
            "order_purchase_timestamp", "order_approved_at",
            "order_delivered_carrier_date", "order_delivered_customer_date",
            "order_estimated_delivery_date", "_run_date", "_batch_id",
        ),
    ),
    "stg_customers": (
        "customers",
        (
            "customer_id", "customer_unique_id", "customer_zip_code_prefix",
            "customer_city", "customer_state",
        ),
    ),
    "stg_products": (
        "products",
        (
            "product_id", "product_category_name", "product_name_lenght",
            "product_description_lenght", "product_photos_qty", "product_weight_g",
            "product_length_cm", "product_height_cm", "product_width_cm",
        ),
    ),
    "stg_order_items": (
        "order_items",
        (
            "order_id", "order_item_id", "product_id", "seller_id",
            "shipping_limit_date", "price", "freight_value",
        ),
    ),
    "stg_order_payments": (
        "order_payments",
        (
            "order_id", "payment_sequential", "payment_type",
            "payment_installments", "payment_value",
        ),
    ),
}


def staging(model: str, silver: Mapping[str, DataFrame]) -> DataFrame:
    table, columns = STAGING[model]
    return silver[table].select(*columns)
