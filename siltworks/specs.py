"""What each table must look like, as data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

GOOD = "good"
QUARANTINE = "quarantine"


@dataclass(frozen=True)
class Rule:
    """When a row counts as valid; invalid rows go to the quarantine table."""

    reason: str
    column: str
    allowed: tuple[str, ...] = ()
    between: tuple[int, int] | None = None
    above: int | None = None
    null_is_invalid: bool = False
    # True: valid and invalid rows are deduplicated apart from each other.
    splits_first: bool = False

    def holds(self) -> Column:
        """Three-valued: NULL where the tested column is NULL."""
        c = F.col(self.column)
        if self.allowed:
            return c.isin(*self.allowed)
        if self.between is not None:
            return c.between(*self.between)
        return c > self.above

    def outcome(self, on_null: str) -> Column:
        """GOOD, QUARANTINE, or NULL for a row that belongs to neither output."""
        holds = self.holds()
        if self.null_is_invalid or on_null == "quarantine":
            return F.when(holds, GOOD).otherwise(QUARANTINE)
        return F.when(holds, GOOD).when(~holds, QUARANTINE)


@dataclass(frozen=True)
class TableSpec:
    name: str
    contract: tuple[str, ...]
    keys: tuple[str, ...]
    not_null: tuple[str, ...]
    ints: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    money: tuple[str, ...] = ()
    times: tuple[str, ...] = ()
    squashed: tuple[str, ...] = ()
    stripped: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    rule: Rule | None = None


# Accepted codes, column names, keys and bounds of the data set.
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "created", "approved",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "orders",
            contract=("order_id", "customer_id", "order_status"),
            keys=("order_id",),
            not_null=("order_id", "customer_id"),
            times=(
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
            squashed=("order_status",),
            rule=Rule("invalid_order_status", "order_status", allowed=ORDER_STATUSES),
        ),
        TableSpec(
            "customers",
            contract=("customer_id", "customer_city"),
            keys=("customer_id",),
            not_null=("customer_id", "customer_unique_id"),
            ints=("customer_zip_code_prefix",),
            squashed=("customer_city",),
            stripped=("customer_state",),
        ),
        TableSpec(
            "products",
            contract=("product_id", "product_category_name"),
            keys=("product_id",),
            not_null=("product_id",),
            ints=("product_name_lenght", "product_description_lenght", "product_photos_qty"),
            doubles=(
                "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
            ),
            squashed=("product_category_name",),
        ),
        TableSpec(
            "order_items",
            contract=("order_id", "product_id", "price"),
            keys=("order_id", "order_item_id"),
            not_null=("order_id", "product_id", "price"),
            ints=("order_item_id",),
            money=("price", "freight_value"),
            times=("shipping_limit_date",),
            rule=Rule("invalid_price", "price", above=0, splits_first=True),
        ),
        TableSpec(
            "order_payments",
            contract=("order_id", "payment_value"),
            keys=("order_id", "payment_sequential"),
            not_null=("order_id", "payment_value"),
            ints=("payment_sequential", "payment_installments"),
            money=("payment_value",),
            squashed=("payment_type",),
            rule=Rule("invalid_payment_type", "payment_type", allowed=PAYMENT_TYPES),
        ),
        TableSpec(
            "order_reviews",
            contract=("review_id", "order_id"),
            keys=("review_id",),
            not_null=("review_id", "order_id"),
            ints=("review_score",),
            times=("review_creation_date", "review_answer_timestamp"),
            rule=Rule(
                "invalid_review_score", "review_score", between=(1, 5), null_is_invalid=True
            ),
        ),
        TableSpec(
            "sellers",
            contract=("seller_id",),
            keys=("seller_id",),
            not_null=("seller_id",),
            ints=("seller_zip_code_prefix",),
            squashed=("seller_city",),
            stripped=("seller_state",),
        ),
        TableSpec(
            "geolocation",
            contract=("geolocation_zip_code_prefix",),
            keys=("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
            not_null=("geolocation_zip_code_prefix",),
            ints=("geolocation_zip_code_prefix",),
            doubles=("geolocation_lat", "geolocation_lng"),
            squashed=("geolocation_city",),
            stripped=("geolocation_state",),
            ranges={"geolocation_lat": (-90, 90), "geolocation_lng": (-180, 180)},
        ),
        TableSpec(
            "product_category_name_translation",
            contract=("product_category_name",),
            keys=("product_category_name",),
            not_null=("product_category_name",),
            squashed=("product_category_name", "product_category_name_english"),
        ),
    )
}
