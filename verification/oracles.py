"""The same results in plain SQL, written apart from the library.

Every statement starts from the supplied tables.  Where engines read odd text
differently, the SQL spells the rule out instead of relying on a cast.
"""

from __future__ import annotations

from verification.raw import DOUBLE_TEXT, MONEY_TEXT, NUMBER_TEXT, TIME_TEXT, extract_sql

STATUSES = (
    "'delivered', 'shipped', 'canceled', 'unavailable', "
    "'invoiced', 'processing', 'created', 'approved'"
)
PAYMENT_TYPES = "'credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined'"


def int_of(c: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+([.][0-9]*)?') "
        f"THEN TRY_CAST(regexp_extract(trim({c}), '^[+-]?[0-9]+') AS INTEGER) "
        f"WHEN regexp_full_match(trim({c}), '[+-]?[.][0-9]*') THEN 0 END"
    )


def money_of(c: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({c}, '[+-]?[0-9]+([.][0-9]*)?') "
        f"THEN TRY_CAST({c} AS DECIMAL(10,2)) END"
    )


def double_of(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def time_of(c: str) -> str:
    pattern = "[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}"
    return f"CASE WHEN regexp_full_match({c}, '{pattern}') THEN TRY_CAST({c} AS TIMESTAMP) END"


def lower_of(c: str) -> str:
    return f"lower(trim({c}))"


def trim_of(c: str) -> str:
    return f"trim({c})"


def _typed(table: str, **columns) -> str:
    """CTE body: the extract with some columns replaced by typed ones."""
    replaced = ", ".join(
        f"{convert(c)} AS {c}" for convert, names in columns.values() for c in names
    )
    return f"SELECT * REPLACE ({replaced}) FROM ({extract_sql(table)})"


def _first(rows: str, keys: str, order: str) -> str:
    ordered = ", ".join(f"{c} NULLS LAST" for c in order.split())
    return (
        f"SELECT * EXCLUDE (rank_in_key) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY {ordered}) AS rank_in_key FROM ({rows})) "
        "WHERE rank_in_key = 1"
    )


TYPED = {
    "orders": _typed(
        "orders",
        times=(time_of, (
            "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date")),
        lowered=(lower_of, ("order_status",)),
    ),
    "customers": _typed(
        "customers",
        ints=(int_of, ("customer_zip_code_prefix",)),
        lowered=(lower_of, ("customer_city",)),
        trimmed=(trim_of, ("customer_state",)),
    ),
    "products": _typed(
        "products",
        ints=(int_of, (
            "product_name_lenght", "product_description_lenght", "product_photos_qty")),
        doubles=(double_of, (
            "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")),
        lowered=(lower_of, ("product_category_name",)),
    ),
    "order_items": _typed(
        "order_items",
        ints=(int_of, ("order_item_id",)),
        money=(money_of, ("price", "freight_value")),
        times=(time_of, ("shipping_limit_date",)),
    ),
    "order_payments": _typed(
        "order_payments",
        ints=(int_of, ("payment_sequential", "payment_installments")),
        money=(money_of, ("payment_value",)),
        lowered=(lower_of, ("payment_type",)),
    ),
    "order_reviews": _typed(
        "order_reviews",
        ints=(int_of, ("review_score",)),
        times=(time_of, ("review_creation_date", "review_answer_timestamp")),
    ),
    "sellers": _typed(
        "sellers",
        ints=(int_of, ("seller_zip_code_prefix",)),
        lowered=(lower_of, ("seller_city",)),
        trimmed=(trim_of, ("seller_state",)),
    ),
    "geolocation": _typed(
        "geolocation",
        ints=(int_of, ("geolocation_zip_code_prefix",)),
        doubles=(double_of, ("geolocation_lat", "geolocation_lng")),
        lowered=(lower_of, ("geolocation_city",)),
        trimmed=(trim_of, ("geolocation_state",)),
    ),
    "product_category_name_translation": _typed(
        "product_category_name_translation",
        lowered=(lower_of, ("product_category_name", "product_category_name_english")),
    ),
}

_ORDER_TIMES = (
    "order_purchase_timestamp order_approved_at order_delivered_carrier_date "
    "order_delivered_customer_date order_estimated_delivery_date"
)
_ITEMS_KEYED = (
    f"SELECT * FROM ({TYPED['order_items']}) "
    "WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND price IS NOT NULL"
)
_ITEM_ORDER = "product_id seller_id shipping_limit_date price freight_value"
_ITEM_KEYS = "order_id, order_item_id"

# One row per key, before good and bad rows are told apart.
DISTINCT = {
    "orders": _first(
        f"SELECT * FROM ({TYPED['orders']}) WHERE order_id IS NOT NULL AND customer_id IS NOT NULL",
        "order_id", f"customer_id order_status {_ORDER_TIMES}",
    ),
    "customers": _first(
        f"SELECT * FROM ({TYPED['customers']}) "
        "WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL",
        "customer_id",
        "customer_unique_id customer_zip_code_prefix customer_city customer_state",
    ),
    "products": _first(
        f"SELECT * FROM ({TYPED['products']}) WHERE product_id IS NOT NULL",
        "product_id",
        "product_category_name product_name_lenght product_description_lenght "
        "product_photos_qty product_weight_g product_length_cm product_height_cm "
        "product_width_cm",
    ),
    "order_payments": _first(
        f"SELECT * FROM ({TYPED['order_payments']}) "
        "WHERE order_id IS NOT NULL AND payment_value IS NOT NULL",
        "order_id, payment_sequential", "payment_type payment_installments payment_value",
    ),
    "order_reviews": _first(
        f"SELECT * FROM ({TYPED['order_reviews']}) "
        "WHERE review_id IS NOT NULL AND order_id IS NOT NULL",
        "review_id",
        "order_id review_score review_comment_message review_creation_date "
        "review_answer_timestamp",
    ),
    "sellers": _first(
        f"SELECT * FROM ({TYPED['sellers']}) WHERE seller_id IS NOT NULL",
        "seller_id", "seller_zip_code_prefix seller_city seller_state",
    ),
    "geolocation": _first(
        f"SELECT * FROM ({TYPED['geolocation']}) "
        "WHERE geolocation_zip_code_prefix IS NOT NULL "
        "AND geolocation_lat >= -90 AND geolocation_lat <= 90 "
        "AND geolocation_lng >= -180 AND geolocation_lng <= 180",
        "geolocation_zip_code_prefix, geolocation_lat, geolocation_lng",
        "geolocation_city geolocation_state",
    ),
    "product_category_name_translation": _first(
        f"SELECT * FROM ({TYPED['product_category_name_translation']}) "
        "WHERE product_category_name IS NOT NULL",
        "product_category_name", "product_category_name_english",
    ),
}

GOOD = {
    **DISTINCT,
    "orders": f"SELECT * FROM ({DISTINCT['orders']}) WHERE order_status IN ({STATUSES})",
    "order_items": _first(f"SELECT * FROM ({_ITEMS_KEYED}) WHERE price > 0", _ITEM_KEYS, _ITEM_ORDER),
    "order_payments": (
        f"SELECT * FROM ({DISTINCT['order_payments']}) WHERE payment_type IN ({PAYMENT_TYPES})"
    ),
    "order_reviews": (
        f"SELECT * FROM ({DISTINCT['order_reviews']}) WHERE review_score IN (1, 2, 3, 4, 5)"
    ),
}
BAD = {
    "orders": (
        "invalid_order_status",
        f"SELECT * FROM ({DISTINCT['orders']}) WHERE order_status NOT IN ({STATUSES})",
    ),
    "order_items": (
        "invalid_price",
        _first(f"SELECT * FROM ({_ITEMS_KEYED}) WHERE price <= 0", _ITEM_KEYS, _ITEM_ORDER),
    ),
    "order_payments": (
        "invalid_payment_type",
        f"SELECT * FROM ({DISTINCT['order_payments']}) "
        f"WHERE payment_type NOT IN ({PAYMENT_TYPES})",
    ),
    "order_reviews": (
        "invalid_review_score",
        f"SELECT * FROM ({DISTINCT['order_reviews']}) "
        "WHERE review_score IS NULL OR review_score NOT IN (1, 2, 3, 4, 5)",
    ),
}


def plain(sql: str, *money: str) -> str:
    """Money columns as doubles, the way the registered queries return them."""
    if not money:
        return sql
    shown = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in money)
    return f"SELECT * REPLACE ({shown}) FROM ({sql})"


_MONEY = {"order_items": ("price", "freight_value"), "order_payments": ("payment_value",)}
_NOW = "TIMESTAMP '2024-03-01 12:00:00'"


def _silver(table: str) -> str:
    return plain(
        f"SELECT *, {_NOW} AS _silver_timestamp, 'silver-1' AS _batch_id, "
        f"'2024-03-01' AS _run_date FROM ({GOOD[table]})",
        *_MONEY.get(table, ()),
    )


def _quarantine(table: str, sql: str | None = None) -> str:
    reason, rows = BAD[table]
    return plain(
        "SELECT *, 'bronze-1' AS _batch_id, '2024-02-29' AS _run_date, "
        f"'{reason}' AS quarantine_reason, {_NOW} AS quarantined_at FROM ({sql or rows})",
        *_MONEY.get(table, ()),
    )


_STG_ORDERS = (
    "SELECT *, '2024-03-01' AS _run_date, 'silver-1' AS _batch_id FROM (" + GOOD["orders"] + ")"
)

_CUSTOMER_STATS = f"""
    SELECT customer_id, count(*) AS total_orders,
           min(order_purchase_timestamp) AS first_order_date,
           max(order_purchase_timestamp) AS last_order_date
    FROM ({GOOD['orders']}) GROUP BY customer_id"""
_PRODUCT_SALES = f"""
    SELECT product_id, count(*) AS times_ordered, sum(price) AS total_revenue,
           CAST((2 * CAST(100 * sum(price) AS HUGEINT) + count(*)) // (2 * count(*)) AS DOUBLE)
             / 100 AS avg_price
    FROM ({GOOD['order_items']}) GROUP BY product_id"""
_ORDER_PAYMENTS = f"""
    SELECT order_id, sum(payment_value) AS total_payment_value, count(*) AS payment_count,
           max(payment_type) AS primary_payment_type
    FROM ({GOOD['order_payments']}) GROUP BY order_id"""
_ORDER_ITEMS = f"""
    SELECT order_id, count(*) AS item_count, sum(price) AS items_total,
           sum(freight_value) AS freight_total
    FROM ({GOOD['order_items']}) GROUP BY order_id"""

_DIM_CUSTOMERS = f"""
    SELECT c.*, coalesce(s.total_orders, 0) AS total_orders, s.first_order_date,
           s.last_order_date, {_NOW} AS dbt_updated_at
    FROM ({GOOD['customers']}) c LEFT JOIN ({_CUSTOMER_STATS}) s USING (customer_id)"""
_DIM_PRODUCTS = f"""
    SELECT p.product_id, p.product_category_name,
           ifnull(t.product_category_name_english, p.product_category_name)
             AS product_category_name_english,
           p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
           ifnull(s.times_ordered, 0) AS times_ordered,
           CAST(ifnull(s.total_revenue, 0) AS DOUBLE) AS total_revenue,
           ifnull(s.avg_price, 0) AS avg_price, {_NOW} AS dbt_updated_at
    FROM ({GOOD['products']}) p
    LEFT JOIN ({_PRODUCT_SALES}) s USING (product_id)
    LEFT JOIN ({GOOD['product_category_name_translation']}) t USING (product_category_name)"""
_FCT_ORDERS = f"""
    SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
           o.order_approved_at, o.order_delivered_customer_date,
           o.order_estimated_delivery_date,
           ifnull(i.item_count, 0) AS item_count,
           CAST(ifnull(i.items_total, 0) AS DOUBLE) AS items_total,
           CAST(ifnull(i.freight_total, 0) AS DOUBLE) AS freight_total,
           CAST(ifnull(p.total_payment_value, 0) AS DOUBLE) AS total_payment_value,
           ifnull(p.payment_count, 0) AS payment_count,
           ifnull(p.primary_payment_type, 'unknown') AS primary_payment_type,
           date_sub('day', o.order_purchase_timestamp, o.order_delivered_customer_date)
             AS delivery_days,
           o.order_delivered_customer_date IS NOT NULL
             AND o.order_estimated_delivery_date IS NOT NULL
             AND o.order_delivered_customer_date <= o.order_estimated_delivery_date
             AS delivered_on_time,
           o._run_date, o._batch_id
    FROM ({_STG_ORDERS}) o
    LEFT JOIN ({_ORDER_PAYMENTS}) p ON p.order_id = o.order_id
    LEFT JOIN ({_ORDER_ITEMS}) i ON i.order_id = o.order_id"""



def _fact_on_second_day() -> str:
    """The fact rebuilt from changed tables; orders that have not changed keep the first run's marks."""
    number = "CAST(order_id AS BIGINT)"
    orders = f"""
        SELECT * REPLACE (CASE WHEN {number} % 50 = 5 THEN 'delivered' ELSE order_status END AS order_status),
               {number} % 20 = 7 OR ({number} % 50 = 5 AND order_status <> 'delivered') AS differs
        FROM ({GOOD['orders']})"""
    payments = f"""
        SELECT * REPLACE (payment_value * CASE WHEN {number} % 10 = 1 THEN 2 ELSE 1 END AS payment_value)
        FROM ({GOOD['order_payments']}) WHERE {number} % 10 <> 2"""
    items = f"""
        SELECT order_id, price + CASE WHEN {number} % 10 = 4 THEN 1 ELSE 0 END AS price, freight_value
        FROM ({GOOD['order_items']})
        UNION ALL SELECT order_id, price, freight_value FROM ({GOOD['order_items']}) WHERE {number} % 10 = 3"""
    return f"""
        WITH o AS ({orders}), p AS (
            SELECT order_id, sum(payment_value) AS total_payment_value, count(*) AS payment_count,
                   max(payment_type) AS primary_payment_type
            FROM ({payments}) GROUP BY order_id
        ), i AS (
            SELECT order_id, count(*) AS item_count, sum(price) AS items_total,
                   sum(freight_value) AS freight_total
            FROM ({items}) GROUP BY order_id
        ), touched AS (
            SELECT order_id FROM ({GOOD['order_payments']})
            WHERE {number} % 10 = 2 OR ({number} % 10 = 1 AND payment_value <> 0)
            UNION SELECT order_id FROM ({GOOD['order_items']}) WHERE {number} % 10 IN (3, 4)
            UNION SELECT order_id FROM o WHERE differs
        )
        SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
               o.order_approved_at, o.order_delivered_customer_date,
               o.order_estimated_delivery_date, ifnull(i.item_count, 0) AS item_count,
               CAST(ifnull(i.items_total, 0) AS DOUBLE) AS items_total,
               CAST(ifnull(i.freight_total, 0) AS DOUBLE) AS freight_total,
               CAST(ifnull(p.total_payment_value, 0) AS DOUBLE) AS total_payment_value,
               ifnull(p.payment_count, 0) AS payment_count,
               ifnull(p.primary_payment_type, 'unknown') AS primary_payment_type,
               date_sub('day', o.order_purchase_timestamp, o.order_delivered_customer_date)
                 AS delivery_days,
               o.order_delivered_customer_date IS NOT NULL
                 AND o.order_estimated_delivery_date IS NOT NULL
                 AND o.order_delivered_customer_date <= o.order_estimated_delivery_date
                 AS delivered_on_time,
               CASE WHEN t.order_id IS NULL THEN '2024-03-01' ELSE '2024-03-02' END AS _run_date,
               CASE WHEN t.order_id IS NULL THEN 'silver-1' ELSE 'silver-2' END AS _batch_id
        FROM o LEFT JOIN p USING (order_id) LEFT JOIN i USING (order_id)
        LEFT JOIN touched t ON t.order_id = o.order_id"""


# Two loads of the fact: they share the orders bought in 1999.
_FIRST_LOAD = f"SELECT * FROM ({_FCT_ORDERS}) WHERE order_purchase_timestamp < TIMESTAMP '2000-01-01'"
_SECOND_LOAD = (
    "SELECT * REPLACE ('delivered' AS order_status, 'silver-2' AS _batch_id) "
    f"FROM ({_FCT_ORDERS}) WHERE order_purchase_timestamp >= TIMESTAMP '1999-01-01' "
    "OR order_purchase_timestamp IS NULL"
)

_T1, _T2, _T3 = (f"TIMESTAMP '2024-0{m}-01 06:30:00.125'" for m in (1, 2, 3))
_SNAP_1 = f"SELECT * FROM ({GOOD['customers']}) WHERE customer_id NOT LIKE 'idle-%'"
_SNAP_2 = f"""
    SELECT * REPLACE (
        CASE WHEN customer_zip_code_prefix % 5 = 0 THEN 'moved' ELSE customer_city END
          AS customer_city,
        CASE WHEN customer_zip_code_prefix % 6 = 0 THEN NULL ELSE customer_state END
          AS customer_state,
        ifnull(customer_zip_code_prefix, 1) AS customer_zip_code_prefix,
        CASE WHEN customer_zip_code_prefix % 4 = 0 THEN 'other' ELSE customer_unique_id END
          AS customer_unique_id)
    FROM ({GOOD['customers']})
    WHERE customer_zip_code_prefix IS NULL OR customer_zip_code_prefix % 7 <> 0"""
_SNAP_3 = GOOD["customers"]


def _opened(rows: str, at: str) -> str:
    stamp = f"strftime({at}, '%Y-%m-%d %H:%M:%S.%f')"
    return (
        f"SELECT *, md5(customer_id || '|' || {stamp}) AS dbt_scd_id, {at} AS dbt_updated_at, "
        f"{at} AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM ({rows})"
    )


def _next_history(before: str, snap: str, at: str) -> str:
    """Old versions with their end times, then one new version per new or changed key."""
    same = " AND ".join(
        f"h.{c} IS NOT DISTINCT FROM s.{c}"
        for c in ("customer_city", "customer_state", "customer_zip_code_prefix")
    )
    return f"""
        SELECT h.* REPLACE (CASE
                 WHEN h.dbt_valid_to IS NOT NULL THEN h.dbt_valid_to
                 WHEN NOT EXISTS (SELECT 1 FROM ({snap}) s
                                  WHERE s.customer_id = h.customer_id AND {same}) THEN {at}
               END AS dbt_valid_to)
        FROM ({before}) h
        UNION ALL
        SELECT * FROM ({_opened(f'''
            SELECT s.* FROM ({snap}) s
            WHERE NOT EXISTS (SELECT 1 FROM ({before}) h
                              WHERE h.customer_id = s.customer_id
                                AND h.dbt_valid_to IS NULL AND {same})''', at)})"""


def _history(t1: str, t2: str, t3: str) -> str:
    return f"""
    WITH s1 AS MATERIALIZED ({_SNAP_1}), s2 AS MATERIALIZED ({_SNAP_2}),
         s3 AS MATERIALIZED ({_SNAP_3}),
         h1 AS MATERIALIZED ({_opened('SELECT * FROM s1', t1)}),
         h2 AS MATERIALIZED ({_next_history('SELECT * FROM h1', 'SELECT * FROM s2', t2)}),
         h3 AS MATERIALIZED ({_next_history('SELECT * FROM h2', 'SELECT * FROM s3', t3)})
    SELECT * FROM h3"""


_HISTORY = _history(_T1, _T2, _T3)
_HISTORY_OF_ORDERS = _history(*(f"TIMESTAMP '{y}-06-15 07:00:00'" for y in (1993, 1995, 1997)))

# model, column, test, severity, SQL condition of a failing row (or None: repeated values)
_STAGE_CHECKS = [
    ("stg_orders", "order_id", "not_null", "error", "order_id IS NULL"),
    ("stg_orders", "order_id", "unique", "error", None),
    ("stg_orders", "customer_id", "not_null", "error", "customer_id IS NULL"),
    ("stg_orders", "order_status", "not_null", "error", "order_status IS NULL"),
    ("stg_orders", "order_status", "accepted_values", "error",
     f"order_status NOT IN ({STATUSES})"),
    ("stg_customers", "customer_id", "not_null", "error", "customer_id IS NULL"),
    ("stg_customers", "customer_id", "unique", "error", None),
    ("stg_customers", "customer_unique_id", "not_null", "error", "customer_unique_id IS NULL"),
    ("stg_customers", "customer_city", "not_null", "error", "customer_city IS NULL"),
    ("stg_customers", "customer_state", "not_null", "error", "customer_state IS NULL"),
    ("stg_products", "product_id", "not_null", "error", "product_id IS NULL"),
    ("stg_products", "product_id", "unique", "error", None),
    ("stg_products", "product_weight_g", "expression_is_true(>= 0)", "error",
     "product_weight_g < 0"),
    ("stg_products", "product_length_cm", "expression_is_true(>= 0)", "error",
     "product_length_cm < 0"),
    ("stg_products", "product_height_cm", "expression_is_true(>= 0)", "error",
     "product_height_cm < 0"),
    ("stg_products", "product_width_cm", "expression_is_true(>= 0)", "error",
     "product_width_cm < 0"),
    ("stg_order_items", "order_id", "not_null", "error", "order_id IS NULL"),
    ("stg_order_items", "product_id", "not_null", "error", "product_id IS NULL"),
    ("stg_order_items", "price", "not_null", "error", "price IS NULL"),
    ("stg_order_items", "price", "expression_is_true(> 0)", "error", "price <= 0"),
    ("stg_order_items", "freight_value", "not_null", "error", "freight_value IS NULL"),
    ("stg_order_items", "freight_value", "expression_is_true(>= 0)", "error",
     "freight_value < 0"),
    ("stg_order_payments", "order_id", "not_null", "error", "order_id IS NULL"),
    ("stg_order_payments", "payment_type", "not_null", "error", "payment_type IS NULL"),
    ("stg_order_payments", "payment_type", "accepted_values", "warn",
     f"payment_type NOT IN ({PAYMENT_TYPES})"),
    ("stg_order_payments", "payment_value", "not_null", "error", "payment_value IS NULL"),
    ("stg_order_payments", "payment_value", "expression_is_true(>= 0)", "error",
     "payment_value < 0"),
]
_MART_CHECKS = [
    ("fct_orders", "order_id", "not_null", "error", "order_id IS NULL"),
    ("fct_orders", "order_id", "unique", "error", None),
    ("fct_orders", "customer_id", "not_null", "error", "customer_id IS NULL"),
    ("fct_orders", "order_status", "not_null", "error", "order_status IS NULL"),
    ("fct_orders", "order_status", "accepted_values", "error",
     f"order_status NOT IN ({STATUSES})"),
    ("fct_orders", "total_payment_value", "not_null", "error", "total_payment_value IS NULL"),
    ("dim_customers", "customer_id", "not_null", "error", "customer_id IS NULL"),
    ("dim_customers", "customer_id", "unique", "error", None),
    ("dim_customers", "customer_city", "not_null", "error", "customer_city IS NULL"),
    ("dim_products", "product_id", "not_null", "error", "product_id IS NULL"),
    ("dim_products", "product_id", "unique", "error", None),
]
_STAGE_TABLE = {
    "stg_orders": "orders", "stg_customers": "customers", "stg_products": "products",
    "stg_order_items": "order_items", "stg_order_payments": "order_payments",
}


def _check_rows(checks: list, models: dict[str, str]) -> str:
    rows = []
    for model, column, test, severity, failing in checks:
        if failing is None:
            count = (
                f"SELECT count(*) FROM (SELECT {column} FROM ({models[model]}) "
                f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
            )
        else:
            count = f"SELECT count(*) FROM ({models[model]}) WHERE {failing}"
        rows.append(
            f"SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test, "
            f"'{severity}' AS severity, ({count}) AS failures"
        )
    return (
        "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM ("
        + " UNION ALL ".join(rows) + ")"
    )


_CLEAN_MODELS = {m: GOOD[t] for m, t in _STAGE_TABLE.items()} | {
    "fct_orders": _FCT_ORDERS, "dim_customers": _DIM_CUSTOMERS, "dim_products": _DIM_PRODUCTS,
}


def _counts(rows: list[tuple[str, str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, 'succeeded' AS status, "
        f"(SELECT count(*) FROM ({sql})) AS row_count, {bad} AS quarantined"
        for layer, table, sql, bad in rows
    )


def _run_counts() -> str:
    tables = list(TYPED)
    rows = [("bronze", t, extract_sql(t), "CAST(NULL AS BIGINT)") for t in tables]
    for t in tables:
        bad = f"(SELECT count(*) FROM ({BAD[t][1]}))" if t in BAD else "CAST(NULL AS BIGINT)"
        rows.append(("silver", t, GOOD[t], bad))
    for name, sql in (
        ("dim_customers", _DIM_CUSTOMERS), ("dim_products", _DIM_PRODUCTS),
        ("fct_orders", _FCT_ORDERS), ("dim_customers_snapshot", GOOD["customers"]),
    ):
        rows.append(("gold", name, sql, "CAST(NULL AS BIGINT)"))
    return _counts(rows)


_RUN_RECORDS = """
    SELECT event_type AS pipeline_name, CAST(CAST(ts AS DATE) AS STRING) AS run_date,
           CASE WHEN value < 5 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
           CAST(event_id AS STRING) AS execution_arn,
           left(CAST(ts AS STRING), 19) AS started_at
    FROM events"""


def _age(name: str, newest: str, warn: int, error: int) -> str:
    age = f"epoch_us(TIMESTAMP '2024-03-01 00:00:00') - epoch_us(({newest}))"
    return (
        f"SELECT '{name}' AS source, ({newest}) AS max_loaded_at, "
        f"CASE WHEN ({newest}) IS NULL OR {age} > {error} * 3600000000 THEN 'error' "
        f"WHEN {age} > {warn} * 3600000000 THEN 'warn' ELSE 'pass' END AS status"
    )


def _contract_rows() -> str:
    lost = {"order_items": "price", "sellers": "seller_id"}
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{lost.get(t, '')}' AS missing, "
        f"(SELECT count(*) FROM ({extract_sql(t)})) AS row_count, "
        f"'{'rejected' if t in lost else 'accepted'}' AS status"
        for t in TYPED
    )


def _moved_customers(before: str, after: str) -> str:
    """One version of each customer, and a second of those that moved; a note before and after."""
    first, second = "TIMESTAMP '2024-01-01 06:30:00.125'", "TIMESTAMP '2024-02-01 06:30:00.125'"
    return f"""
        SELECT c_custkey AS customer_id, c_mktsegment AS customer_city,
               CAST({before} AS VARCHAR) AS note, {first} AS dbt_valid_from,
               CASE WHEN c_custkey % 5 = 0 THEN {second} END AS dbt_valid_to
        FROM customer
        UNION ALL
        SELECT c_custkey, 'moved', CAST({after} AS VARCHAR), {second}, NULL
        FROM customer WHERE c_custkey % 5 = 0"""


def _views() -> str:
    """Views of a run: what each stage has written, and the staging models over cleaned tables."""
    rows = [("bronze", t, extract_sql(t)) for t in TYPED] + [("silver", t, GOOD[t]) for t in TYPED]
    rows += [("silver", f"quarantine_{t}", BAD[t][1]) for t in BAD]
    rows += [("gold", m, GOOD[t]) for m, t in _STAGE_TABLE.items()]
    rows += [
        ("gold", "dim_customers", _DIM_CUSTOMERS), ("gold", "dim_products", _DIM_PRODUCTS),
        ("gold", "fct_orders", _FCT_ORDERS), ("gold", "dim_customers_snapshot", GOOD["customers"]),
    ]
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{v}' AS view_name, (SELECT count(*) FROM ({sql})) AS row_count"
        for layer, v, sql in rows
    )


def _gates() -> str:
    """Two extracts are rejected; a check that fails blocks what is built from its table."""
    status = {("bronze", "sellers"): "failed", ("bronze", "geolocation"): "failed"}
    gold = ("dim_customers", "dim_products", "fct_orders", "dim_customers_snapshot")
    for name in ("dim_customers", "dim_customers_snapshot"):
        status["gold", name] = f"CASE WHEN (SELECT count(*) FROM ({GOOD['customers']})) > 0 THEN 'skipped' ELSE 'succeeded' END"
    rows = [(layer, t) for layer in ("bronze", "silver") for t in TYPED] + [("gold", t) for t in gold]
    shown = (
        (layer, t, found if (found := status.get((layer, t), "succeeded")).startswith("CASE") else f"'{found}'")
        for layer, t in rows
    )
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, {text} AS status" for layer, t, text in shown
    )


def oracle_sql() -> dict[str, str]:
    items_sql = "SELECT l_orderkey, l_linenumber, {} AS raw FROM lineitem"
    documents = (
        "SELECT CAST(doc_id AS STRING) AS doc_id, text, lang, source, "
        "CAST(n_chars AS STRING) AS n_chars FROM documents"
    )
    oracles = {
        # sources and gates
        "ingest_csv_roundtrip": documents,
        "ingest_long_csv": (
            f"{documents} UNION ALL SELECT 'o' || o_orderkey, '5\" \"' || o_orderstatus || '\" wide', "
            "'e\"n', 'src\"', '1' FROM orders"
        ),
        "ingest_stamped": (
            "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS "
            f"o_custkey, o_orderstatus, {_NOW} AS _ingestion_timestamp, 'csv' AS _source_file, "
            "'bronze-1' AS _batch_id, '2024-02-29' AS _run_date FROM orders"
        ),
        "contract_report": _contract_rows(),
        # scalar building blocks
        "cast_int_legacy": (
            f"SELECT *, {int_of('raw')} AS value FROM ({items_sql.format(NUMBER_TEXT)})"
        ),
        "cast_decimal": (
            "SELECT l_orderkey, l_linenumber, raw, CAST(CASE "
            "WHEN raw = 'n/a' OR raw LIKE '1234567%' THEN NULL "
            "WHEN raw LIKE '-%' THEN -floor(abs(CAST(raw AS DECIMAL(18,4))) * 100 + 0.5) / 100 "
            "ELSE floor(CAST(raw AS DECIMAL(18,4)) * 100 + 0.5) / 100 END AS DOUBLE) AS value "
            f"FROM ({items_sql.format(MONEY_TEXT)})"
        ),
        "cast_double": (
            "SELECT l_orderkey, l_linenumber, raw, "
            "CASE WHEN raw NOT IN ('wide', '') THEN CAST(raw AS DOUBLE) END AS value "
            f"FROM ({items_sql.format(DOUBLE_TEXT)})"
        ),
        "cast_timestamp": (
            "SELECT o_orderkey, raw, CASE "
            "WHEN length(raw) = 4 THEN CAST(raw || '-01-01' AS TIMESTAMP) "
            "WHEN length(raw) = 7 THEN CAST(raw || '-01' AS TIMESTAMP) "
            "WHEN raw LIKE '%/%' OR raw = '2017-02-30 00:00:00' THEN NULL "
            "ELSE CAST(raw AS TIMESTAMP) END AS value "
            f"FROM (SELECT o_orderkey, {TIME_TEXT} AS raw FROM orders)"
        ),
        "normalise_text": (
            "SELECT order_id, lower(trim(order_status)) AS squashed, trim(order_status) AS "
            f"stripped FROM ({extract_sql('orders')})"
        ),
        "money_text": (
            "SELECT order_id, order_item_id, CAST(price AS VARCHAR) AS price, "
            "CAST(freight_value AS VARCHAR) AS freight_value, 'decimal(10,2)' AS price_type "
            f"FROM ({GOOD['order_items']})"
        ),
        # filters and dedupe
        "filter_not_null": (
            f"SELECT * FROM ({TYPED['customers']}) "
            "WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL"
        ),
        "filter_range": (
            f"SELECT * FROM ({TYPED['geolocation']}) WHERE geolocation_lat BETWEEN -90 AND 90 "
            "AND geolocation_lng BETWEEN -180 AND 180"
        ),
        "filter_positive": plain(
            f"SELECT * FROM ({TYPED['order_items']}) WHERE price > 0", "price", "freight_value"
        ),
        "filter_isin": (
            f"SELECT order_id, order_status, order_status IN ({STATUSES}) AS accepted "
            f"FROM ({TYPED['orders']}) WHERE order_status IS NOT NULL"
        ),
        "dedupe_items": _first(
            "SELECT * FROM lineitem", "l_orderkey, l_linenumber",
            "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax "
            "l_returnflag l_linestatus l_shipdate",
        ),
        # staging
        "stg_orders": _STG_ORDERS,
        "stg_customers": GOOD["customers"],
        "stg_products": GOOD["products"],
        "stg_items": plain(GOOD["order_items"], *_MONEY["order_items"]),
        "stg_payments": plain(GOOD["order_payments"], *_MONEY["order_payments"]),
        # aggregates
        "customer_order_stats": _CUSTOMER_STATS,
        "product_sales": plain(_PRODUCT_SALES, "total_revenue"),
        "order_payments_agg": plain(_ORDER_PAYMENTS, "total_payment_value"),
        "order_items_agg": plain(_ORDER_ITEMS, "items_total", "freight_total"),
        # reporting tables
        "dim_customers": _DIM_CUSTOMERS,
        "dim_products": _DIM_PRODUCTS,
        "fct_orders": _FCT_ORDERS,
        "fact_preview": f"SELECT * FROM ({_FCT_ORDERS}) ORDER BY order_id LIMIT 10",
        "delivery_days": (
            "SELECT event_id, date_sub('day', ts, ts + INTERVAL '1' HOUR * (event_id % 400 - 200)) "
            "AS days FROM events"
        ),
        "on_time_flag": (
            "SELECT event_id, CASE WHEN event_id % 9 = 0 THEN false "
            "ELSE ts <= ts + INTERVAL '1' HOUR * (event_id % 3 - 1) END AS on_time FROM events"
        ),
        # table maintenance
        "fact_upsert": (
            f"SELECT * FROM ({_SECOND_LOAD}) UNION ALL SELECT * FROM ({_FIRST_LOAD}) WHERE "
            f"order_id NOT IN (SELECT order_id FROM ({_SECOND_LOAD}))"
        ),
        "fact_upsert_new_column": f"""
            SELECT *, 'late' AS channel, CAST(CASE WHEN order_purchase_timestamp
                     < TIMESTAMP '2000-01-01' THEN 1 END AS BIGINT) AS load_no
            FROM ({_SECOND_LOAD})
            UNION ALL
            SELECT *, NULL, 1 FROM ({_FIRST_LOAD})
            WHERE order_id NOT IN (SELECT order_id FROM ({_SECOND_LOAD}))""",
        "upsert_after_conflict": (
            "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN 'late' ELSE o_orderstatus END "
            "AS o_orderstatus, o_orderdate FROM orders"
        ),
        "fct_orders_incremental": _fact_on_second_day(),
        "fct_orders_clustered": _FCT_ORDERS,
        "fact_compacted": plain(TYPED["order_payments"], "payment_value"),
        "version_read": "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders",
        "version_rollback": (
            "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders"
        ),
        # history
        "customer_history": _HISTORY,
        "customer_history_as_of": (
            f"SELECT * FROM ({_HISTORY}) WHERE dbt_valid_from <= TIMESTAMP '2024-02-15' "
            "AND (dbt_valid_to IS NULL OR dbt_valid_to > TIMESTAMP '2024-02-15')"
        ),
        "orders_with_customer_as_of": f"""
            SELECT o.order_id, o.customer_id, o.order_purchase_timestamp, h.customer_city,
                   h.customer_state, h.dbt_valid_from, h.dbt_valid_to
            FROM ({GOOD['orders']}) o LEFT JOIN ({_HISTORY_OF_ORDERS}) h
              ON h.customer_id = o.customer_id AND h.dbt_valid_from <= o.order_purchase_timestamp
             AND (h.dbt_valid_to IS NULL OR o.order_purchase_timestamp < h.dbt_valid_to)""",
        "history_column_added": _moved_customers("NULL", "c_name"),
        "history_column_removed": _moved_customers("c_name", "NULL"),
        # checks
        "check_results": _check_rows(_STAGE_CHECKS + _MART_CHECKS, _CLEAN_MODELS),
        "check_results_untreated": _check_rows(
            _STAGE_CHECKS, {m: TYPED[t] for m, t in _STAGE_TABLE.items()}
        ),
        "freshness": " UNION ALL ".join(
            (
                _age("orders", "SELECT max(o_orderdate) FROM orders", 24, 48),
                _age("order_items", "SELECT max(l_shipdate) FROM lineitem", 24, 48),
                _age("geolocation", "SELECT max(ts) FROM events", 72, 168),
                _age("product_category_name_translation", "SELECT max(ts) FROM events", 168, 720),
                _age("sellers", "SELECT max(ts) FROM events WHERE value IS NULL", 24, 48),
                _age("customers", "SELECT max(o_orderdate) FROM orders", 24, 48),
                _age("products", "SELECT max(l_shipdate) FROM lineitem", 24, 48),
                _age("order_payments", "SELECT max(ts) FROM events WHERE value > 5", 24, 48),
                _age("order_reviews", "SELECT max(ts) FROM events WHERE value < 5", 24, 48),
            )
        ),
        # runs
        "table_results": _run_counts(),
        "gate_results": _gates(),
        "published_views": _views(),
        "fact_through_view": _FCT_ORDERS,
        "run_ledger": (
            "SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_name, "
            "run_date ORDER BY started_at DESC, execution_arn DESC) AS n "
            f"FROM ({_RUN_RECORDS})) WHERE n = 1"
        ),
    }
    short = {
        "order_items": "items", "order_payments": "payments", "order_reviews": "reviews",
        "product_category_name_translation": "translation",
    }
    for table in TYPED:
        oracles[f"silver_{short.get(table, table)}"] = _silver(table)
    for table in BAD:
        oracles[f"quarantine_{short.get(table, table)}"] = _quarantine(table)
    for table in TYPED:
        oracles[f"stored_{table}"] = _silver(table)
    for table in BAD:
        oracles[f"stored_quarantine_{table}"] = _quarantine(table)
    for table in ("fct_orders", "dim_customers", "dim_products"):
        oracles[f"stored_{table}"] = oracles[table]
    oracles["quarantine_orders_null"] = _quarantine(
        "orders",
        f"SELECT * FROM ({DISTINCT['orders']}) "
        f"WHERE order_status IS NULL OR order_status NOT IN ({STATUSES})",
    )
    oracles["quarantine_payments_null"] = _quarantine(
        "order_payments",
        f"SELECT * FROM ({DISTINCT['order_payments']}) "
        f"WHERE payment_type IS NULL OR payment_type NOT IN ({PAYMENT_TYPES})",
    )
    return oracles
