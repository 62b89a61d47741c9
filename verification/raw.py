"""Untidy text extracts derived from the supplied tables.

The supplied tables are clean and typed.  Each extract below is a list of
SELECT statements, valid in Spark and DuckDB alike, over whole tables: text
columns, NULL keys, bad codes, unreadable numbers and dates, and repeated rows
with other values.  Both sides of every comparison start from these texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def _cents(expression: str) -> str:
    return _text(f"CAST({expression} AS DECIMAL(10,2))")


def _some_null(modulo: str, value: str) -> str:
    return f"CASE WHEN {modulo} = 0 THEN NULL ELSE {value} END"


def _after(start: str, hours: str) -> str:
    return _text(f"{start} + INTERVAL '1' HOUR * ({hours})")


def _select(columns: dict[str, str], tail: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + " FROM " + tail


_ORDERS = {
    "order_id": _some_null("o_orderkey % 101", _text("o_orderkey")),
    "customer_id": _some_null("o_orderkey % 97", _text("o_custkey")),
    "order_status": (
        "CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'bogus' "
        "WHEN o_orderstatus = 'F' THEN '  DELIVERED ' WHEN o_orderstatus = 'O' THEN 'Shipped' "
        "ELSE ' processing' END"
    ),
    "order_purchase_timestamp": (
        "CASE WHEN o_orderkey % 29 = 0 THEN '10/02/2017' ELSE "
        + _after("o_orderdate", "o_orderkey % 24") + " END"
    ),
    "order_approved_at": _some_null(
        "o_orderkey % 31", _after("o_orderdate", "o_orderkey % 24 + 1")
    ),
    "order_delivered_carrier_date": (
        "CASE WHEN o_orderstatus = 'F' THEN " + _after("o_orderdate", "40") + " END"
    ),
    "order_delivered_customer_date": (
        "CASE WHEN o_orderstatus = 'F' THEN "
        + _after("o_orderdate", "o_orderkey % 700") + " END"
    ),
    "order_estimated_delivery_date": _after("o_orderdate", "480"),
}
_ORDERS_AGAIN = {
    **_ORDERS,
    "order_status": "CASE WHEN o_orderkey % 70 = 0 THEN 'lost' ELSE 'CREATED' END",
    "order_purchase_timestamp": _after("o_orderdate", "o_orderkey % 24 + 5"),
}

_ITEMS = {
    "order_id": _some_null("l_orderkey % 89", _text("l_orderkey")),
    "order_item_id": (
        "CASE WHEN l_orderkey % 53 = 0 THEN 'x' WHEN l_linenumber % 3 = 0 THEN "
        f"concat({_text('l_linenumber')}, '.0') ELSE {_text('l_linenumber')} END"
    ),
    "product_id": _some_null("l_partkey % 113", _text("l_partkey")),
    "seller_id": _text("l_suppkey"),
    "shipping_limit_date": _text("l_shipdate"),
    "price": (
        "CASE WHEN l_orderkey % 37 = 0 THEN '0.00' "
        f"WHEN l_orderkey % 41 = 0 THEN concat('-', {_cents('l_extendedprice')}) "
        "WHEN l_orderkey % 43 = 0 THEN 'n/a' WHEN l_orderkey % 47 = 0 THEN '0.004' "
        f"ELSE {_cents('l_extendedprice')} END"
    ),
    "freight_value": _cents("l_quantity"),
}

_PAYMENTS = {
    "order_id": _some_null("l_orderkey % 83", _text("l_orderkey")),
    "payment_sequential": _text("l_linenumber"),
    "payment_type": (
        "CASE WHEN l_orderkey % 31 = 0 THEN 'cash' WHEN l_orderkey % 33 = 0 THEN NULL "
        "WHEN l_returnflag = 'A' THEN 'Credit_Card ' WHEN l_returnflag = 'N' THEN ' BOLETO' "
        "ELSE 'voucher' END"
    ),
    "payment_installments": _text("CAST(l_quantity AS INTEGER)"),
    "payment_value": (
        f"CASE WHEN l_orderkey % 59 = 0 THEN 'n/a' ELSE {_cents('l_extendedprice')} END"
    ),
}

_REVIEWS = {
    "review_id": _some_null("doc_id % 61", _text("doc_id")),
    "order_id": _some_null("doc_id % 67", _text("n_chars")),
    "review_score": (
        "CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'x' "
        f"ELSE {_text('doc_id % 8')} END"
    ),
    "review_comment_message": "text",
    "review_creation_date": _after("TIMESTAMP '2018-01-01 00:00:00'", "doc_id % 5000"),
    "review_answer_timestamp": (
        "CASE WHEN doc_id % 17 = 0 THEN '2018-02-30 00:00:00' ELSE "
        + _after("TIMESTAMP '2018-01-01 00:00:00'", "doc_id % 5000 + 30") + " END"
    ),
}
_REVIEWS_AGAIN = {**_REVIEWS, "review_score": _text("(doc_id + 3) % 8")}

_CUSTOMERS = {
    "customer_id": _some_null("c_custkey % 71", _text("c_custkey")),
    "customer_unique_id": _some_null("c_custkey % 73", f"concat('u', {_text('c_custkey')})"),
    "customer_zip_code_prefix": (
        "CASE WHEN c_custkey % 17 = 0 THEN 'abc' WHEN c_custkey % 13 = 0 THEN "
        f"concat(' ', {_text('10000 + c_custkey % 5000')}, '.7 ') "
        f"ELSE {_text('10000 + c_custkey % 5000')} END"
    ),
    "customer_city": "concat('  ', c_mktsegment)",
    "customer_state": "concat(n_name, ' ')",
}
_CUSTOMERS_AGAIN = {**_CUSTOMERS, "customer_city": "concat('New ', c_mktsegment, ' ')"}
_CUSTOMERS_IDLE = {**_CUSTOMERS, "customer_id": f"concat('idle-', {_text('c_custkey')})"}

_PRODUCTS = {
    "product_id": _some_null("p_partkey % 79", _text("p_partkey")),
    "product_category_name": _some_null("p_partkey % 31", "concat(' ', p_type)"),
    "product_name_lenght": f"concat({_text('length(p_name)')}, '.0')",
    "product_description_lenght": _text("p_size * 10"),
    "product_photos_qty": (
        f"CASE WHEN p_partkey % 7 = 0 THEN '.5' ELSE {_text('p_partkey % 6')} END"
    ),
    "product_weight_g": _cents("p_retailprice"),
    "product_length_cm": _text("p_size"),
    "product_height_cm": (
        f"CASE WHEN p_partkey % 27 = 0 THEN 'tall' ELSE concat({_text('p_size')}, '.5') END"
    ),
    "product_width_cm": _text("p_size + 3"),
}
_PRODUCTS_AGAIN = {**_PRODUCTS, "product_category_name": "concat(p_type, ' ')",
                   "product_description_lenght": _text("p_size * 11")}
_PRODUCTS_UNSOLD = {**_PRODUCTS, "product_id": f"concat('unsold-', {_text('p_partkey')})"}

_SELLERS = {
    "seller_id": _some_null("s_suppkey % 19", _text("s_suppkey")),
    "seller_zip_code_prefix": (
        f"CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE {_text('20000 + s_suppkey')} END"
    ),
    "seller_city": "concat(s_name, '  ')",
    "seller_state": "concat(' ', n_name)",
}
_SELLERS_AGAIN = {**_SELLERS, "seller_city": "concat('branch ', s_name)"}

_PLACES = {
    "geolocation_zip_code_prefix": (
        f"CASE WHEN c_custkey % 67 = 0 THEN 'none' ELSE {_text('10000 + c_custkey % 300')} END"
    ),
    "geolocation_lat": (
        "CASE WHEN c_custkey % 59 = 0 THEN 'NaN' "
        f"ELSE concat({_text('c_custkey % 200 - 100')}, '.25') END"
    ),
    "geolocation_lng": f"concat({_text('c_custkey % 400 - 200')}, '.5')",
    "geolocation_city": "concat(' ', c_mktsegment)",
    "geolocation_state": "concat(n_name, ' ')",
}
_PLACES_AGAIN = {**_PLACES, "geolocation_city": "'Somewhere Else'"}

_CATEGORIES = {
    "product_category_name": "concat(p_type, '  ')",
    "product_category_name_english": "concat(' ', p_type, ' (English)')",
}

_CUSTOMER_NATION = "{customer} JOIN {nation} ON c_nationkey = n_nationkey"
_SUPPLIER_NATION = "{supplier} JOIN {nation} ON s_nationkey = n_nationkey"

_SUPPLIED = ("orders", "lineitem", "customer", "nation", "part", "supplier", "documents")

_EXTRACTS: dict[str, list[str]] = {
    "orders": [
        _select(_ORDERS, "{orders}"),
        _select(_ORDERS_AGAIN, "{orders} WHERE o_orderkey % 10 = 0"),
    ],
    "customers": [
        _select(_CUSTOMERS, _CUSTOMER_NATION),
        _select(_CUSTOMERS_AGAIN, f"{_CUSTOMER_NATION} WHERE c_custkey % 10 = 0"),
        _select(_CUSTOMERS_IDLE, f"{_CUSTOMER_NATION} WHERE c_custkey % 12 = 0"),
    ],
    "products": [
        _select(_PRODUCTS, "{part}"),
        _select(_PRODUCTS_AGAIN, "{part} WHERE p_partkey % 10 = 0"),
        _select(_PRODUCTS_UNSOLD, "{part} WHERE p_partkey % 12 = 0"),
    ],
    "order_items": [_select(_ITEMS, "{lineitem}")],
    "order_payments": [_select(_PAYMENTS, "{lineitem}")],
    "order_reviews": [
        _select(_REVIEWS, "{documents}"),
        _select(_REVIEWS_AGAIN, "{documents} WHERE doc_id % 10 = 0"),
    ],
    "sellers": [
        _select(_SELLERS, _SUPPLIER_NATION),
        _select(_SELLERS_AGAIN, f"{_SUPPLIER_NATION} WHERE s_suppkey % 10 = 0"),
    ],
    "geolocation": [
        _select(_PLACES, _CUSTOMER_NATION),
        _select(_PLACES_AGAIN, f"{_CUSTOMER_NATION} WHERE c_custkey % 4 = 0"),
    ],
    # Every category but one gets a translation; some get it twice.
    "product_category_name_translation": [
        _select(_CATEGORIES, "(SELECT DISTINCT p_type FROM {part} WHERE p_type <> 'SMALL')"),
        _select(
            {**_CATEGORIES, "product_category_name_english": "concat(p_type, ' (again)')"},
            "(SELECT DISTINCT p_type FROM {part} WHERE p_type <> 'SMALL' AND length(p_type) > 7)",
        ),
    ],
}


# Number-like text in the forms that engines read differently.
NUMBER_TEXT = (
    "CASE l_orderkey % 12 "
    "WHEN 0 THEN concat(CAST(l_partkey AS STRING), '.7') "
    "WHEN 1 THEN concat(' ', CAST(l_partkey AS STRING), ' ') "
    "WHEN 2 THEN concat('-', CAST(l_suppkey AS STRING), '.0') "
    "WHEN 3 THEN concat('.', CAST(l_linenumber AS STRING)) "
    "WHEN 4 THEN concat(CAST(l_suppkey AS STRING), '.') "
    "WHEN 5 THEN concat(CAST(l_linenumber AS STRING), 'e3') "
    "WHEN 6 THEN concat('9999999', CAST(10000 + l_partkey AS STRING)) "
    "WHEN 7 THEN '' WHEN 8 THEN 'n/a' "
    "WHEN 9 THEN concat('1.', CAST(l_linenumber AS STRING), '.2') "
    "WHEN 10 THEN concat('+', CAST(l_partkey AS STRING)) "
    "ELSE CAST(l_partkey AS STRING) END"
)
MONEY_TEXT = (
    "CASE l_orderkey % 8 "
    "WHEN 0 THEN concat(CAST(l_partkey AS STRING), '.005') "
    "WHEN 1 THEN concat('-', CAST(l_partkey AS STRING), '.005') "
    "WHEN 2 THEN concat('1234567', CAST(100 + l_suppkey % 100 AS STRING), '.99') "
    "WHEN 3 THEN '0.004' WHEN 4 THEN 'n/a' "
    "WHEN 5 THEN concat(CAST(l_suppkey AS STRING), '.4949') "
    "ELSE CAST(l_linenumber AS STRING) END"
)
DOUBLE_TEXT = (
    "CASE l_orderkey % 6 WHEN 0 THEN concat(CAST(l_partkey AS STRING), '.25') "
    "WHEN 1 THEN concat('-', CAST(l_suppkey AS STRING), '.5') WHEN 2 THEN 'wide' "
    "WHEN 3 THEN '' WHEN 4 THEN concat(CAST(l_linenumber AS STRING), 'e2') "
    "ELSE CAST(l_partkey AS STRING) END"
)
TIME_TEXT = (
    "CASE o_orderkey % 6 WHEN 0 THEN left(CAST(o_orderdate AS STRING), 7) "
    "WHEN 1 THEN left(CAST(o_orderdate AS STRING), 4) "
    "WHEN 2 THEN '10/02/2017' WHEN 3 THEN '2017-02-30 00:00:00' "
    "WHEN 4 THEN left(CAST(o_orderdate AS STRING), 10) "
    "ELSE CAST(o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 100) AS STRING) END"
)


def extract_sql(table: str) -> str:
    """One extract as a SQL query over the supplied tables."""
    text = " UNION ALL ".join(_EXTRACTS[table])
    return text.format_map({name: name for name in _SUPPLIED})


def supplied(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def extract(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One extract as a DataFrame, all columns text."""
    text = " UNION ALL ".join(_EXTRACTS[table])
    used = {n: supplied(spark, sf_dir, n) for n in _SUPPLIED if f"{{{n}}}" in text}
    return spark.sql(text, **used)
