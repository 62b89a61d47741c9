"""The checks and freshness limits that come with the models."""

from __future__ import annotations

from siltworks.operators.quality import (
    ACCEPTED, EXPRESSION, NOT_NULL, UNIQUE, Check, Freshness,
)
from siltworks.specs import ORDER_STATUSES, PAYMENT_TYPES

# Which column of which model is checked for what.
CHECKS: dict[str, tuple[Check, ...]] = {
    "stg_orders": (
        Check("order_id", NOT_NULL),
        Check("order_id", UNIQUE),
        Check("customer_id", NOT_NULL),
        Check("order_status", NOT_NULL),
        Check("order_status", ACCEPTED, allowed=ORDER_STATUSES),
    ),
    "stg_customers": (
        Check("customer_id", NOT_NULL),
        Check("customer_id", UNIQUE),
        Check("customer_unique_id", NOT_NULL),
        Check("customer_city", NOT_NULL),
        Check("customer_state", NOT_NULL),
    ),
    "stg_products": (
        Check("product_id", NOT_NULL),
        Check("product_id", UNIQUE),
        Check("product_weight_g", EXPRESSION, expression=">= 0"),
        Check("product_length_cm", EXPRESSION, expression=">= 0"),
        Check("product_height_cm", EXPRESSION, expression=">= 0"),
        Check("product_width_cm", EXPRESSION, expression=">= 0"),
    ),
    "stg_order_items": (
        Check("order_id", NOT_NULL),
        Check("product_id", NOT_NULL),
        Check("price", NOT_NULL),
        Check("price", EXPRESSION, expression="> 0"),
        Check("freight_value", NOT_NULL),
        Check("freight_value", EXPRESSION, expression=">= 0"),
    ),
    "stg_order_payments": (
        Check("order_id", NOT_NULL),
        Check("payment_type", NOT_NULL),
        Check("payment_type", ACCEPTED, allowed=PAYMENT_TYPES, severity="warn"),
        Check("payment_value", NOT_NULL),
        Check("payment_value", EXPRESSION, expression=">= 0"),
    ),
    "fct_orders": (
        Check("order_id", NOT_NULL),
        Check("order_id", UNIQUE),
        Check("customer_id", NOT_NULL),
        Check("order_status", NOT_NULL),
        Check("order_status", ACCEPTED, allowed=ORDER_STATUSES),
        Check("total_payment_value", NOT_NULL),
    ),
    "dim_customers": (
        Check("customer_id", NOT_NULL),
        Check("customer_id", UNIQUE),
        Check("customer_city", NOT_NULL),
    ),
    "dim_products": (
        Check("product_id", NOT_NULL),
        Check("product_id", UNIQUE),
    ),
}

# Hours until a cleaned table counts as late.
FRESHNESS: dict[str, Freshness] = {
    "orders": Freshness(24, 48),
    "customers": Freshness(24, 48),
    "products": Freshness(24, 48),
    "order_items": Freshness(24, 48),
    "order_payments": Freshness(24, 48),
    "order_reviews": Freshness(24, 48),
    "sellers": Freshness(24, 48),
    "geolocation": Freshness(72, 168),
    "product_category_name_translation": Freshness(168, 720),
}
