"""One query per operator, each over the whole supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from siltworks.functions.casts import squash, strip, to_double, to_int, to_money, to_time
from siltworks.functions.measures import elapsed_days, no_later_than
from siltworks.operators import ledger
from siltworks.operators.as_of import join_as_of
from siltworks.operators.cleanse import (
    cleanse,
    good_rows,
    quarantined_rows,
    stamped,
    typed,
    with_keys,
    within_ranges,
)
from siltworks.operators.dedupe import first_per_key
from siltworks.operators.history import as_known_at
from siltworks.operators.quality import counted_results, evaluate, freshness
from siltworks.operators.upsert import upsert
from siltworks.plans import incremental, marts
from siltworks.plans.checks import CHECKS, FRESHNESS
from siltworks.plans.runs import (
    HISTORY_CHECK,
    HISTORY_KEY,
    StageFailed,
    TableResult,
    files_for,
    refresh_fact,
    results_frame,
    run_bronze,
    run_gold,
    run_silver,
)
from siltworks.plans.staging import STAGING, staging
from siltworks.session import limit_tasks
from siltworks.sources.extracts import (
    extract_path,
    missing_columns,
    read_extract,
    stamp_landing,
)
from siltworks.sources.long_files import read_long_extract
from siltworks.sources.store import TableStore
from siltworks.specs import ORDER_STATUSES, TABLES, Rule
from verification.raw import (
    DOUBLE_TEXT,
    MONEY_TEXT,
    NUMBER_TEXT,
    TIME_TEXT,
    extract,
    supplied,
)
from verification.scratch import scratch

Query = Callable[[SparkSession, str], DataFrame]

NOW = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)
BRONZE_RUN = ("bronze-1", "2024-02-29")
SILVER_RUN = ("silver-1", "2024-03-01")
TRANSLATION = "product_category_name_translation"
# Tables that are read back from a store.
STORED = (
    *TABLES, "quarantine_orders", "quarantine_order_items", "quarantine_order_payments",
    "quarantine_order_reviews",
)
STORED_GOLD = ("fct_orders", "dim_customers", "dim_products")


def plain(df: DataFrame) -> DataFrame:
    """Money as doubles and times without a zone, as the compared SQL returns them."""
    shown = {"timestamp": "timestamp_ntz"}
    return df.select(
        *[
            F.col(c).cast("double" if t.startswith("decimal") else shown.get(t, t)).alias(c)
            for c, t in df.dtypes
        ]
    )


def landed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """An extract with the landing run's batch and date."""
    batch_id, run_date = BRONZE_RUN
    return extract(spark, sf_dir, table).withColumns(
        {"_batch_id": F.lit(batch_id), "_run_date": F.lit(run_date)}
    )


def tagged(spark: SparkSession, sf_dir: str, table: str, on_null: str = "drop") -> DataFrame:
    spec = TABLES[table]
    rows = cleanse(landed(spark, sf_dir, table), spec, on_null)
    return stamped(rows, spec, *SILVER_RUN, NOW)


def silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return good_rows(tagged(spark, sf_dir, table))


def stage(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    table, _ = STAGING[model]
    return staging(model, {table: silver(spark, sf_dir, table)})


def new_store(spark: SparkSession) -> TableStore:
    return TableStore(spark, scratch(spark))


# -- sources and gates ---------------------------------------------------


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def ingest_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = extract_path(scratch(spark), "shop", "2024-02-29", "documents")
    write_csv(supplied(spark, sf_dir, "documents"), path)
    return read_extract(spark, path)


def in_small_blocks(spark: SparkSession, read: Callable[[], DataFrame]) -> DataFrame:
    """Stored rows of a read for which files are cut into blocks of 96 KiB."""
    key, path = "spark.sql.files.maxPartitionBytes", scratch(spark)
    before = spark.conf.get(key)
    spark.conf.set(key, str(96 << 10))
    try:
        read().write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.parquet(path)


def ingest_long_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, and orders with quotes inside plain fields, read in many small blocks."""
    path = extract_path(scratch(spark), "shop", "2024-02-29", "documents")
    write_csv(supplied(spark, sf_dir, "documents"), path)
    orders = supplied(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("doc_id"),
        F.concat(F.lit('5" "'), "o_orderstatus", F.lit('" wide')).alias("text"),
        F.lit('e"n').alias("lang"),
        F.lit('src"').alias("source"),
        F.lit("1").alias("n_chars"),
    )
    orders.write.csv(path, header=True, quote="\u0000", mode="append")

    def read() -> DataFrame:
        rows, file_column = read_long_extract(spark, path)
        return rows.drop(file_column)

    return in_small_blocks(spark, read)


def ingest_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage of a CSV extract that brings a column of the same name; only the kind of file is shown."""
    path = extract_path(scratch(spark), "shop", "2024-02-29", "orders")
    orders = supplied(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    write_csv(orders.withColumn("_source_file", F.lit("fake.txt")), path)
    rows, file_column = read_long_extract(spark, path)
    stamped_rows = stamp_landing(rows, *BRONZE_RUN, NOW, file_column)
    kind = F.regexp_extract("_source_file", "shop_orders_dataset.csv/.*[.](csv)$", 1)
    return plain(stamped_rows.withColumn("_source_file", kind))


def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract and row count per extract; two extracts come with a column lost."""

    def report(table: str) -> DataFrame:
        df = extract(spark, sf_dir, table)
        if table == "order_items":
            df = df.drop("price")
        elif table == "sellers":
            df = df.withColumnRenamed("seller_id", "Seller_ID")
        missing = missing_columns(df, TABLES[table])
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"),
            F.lit(",".join(missing)).alias("missing"),
            "row_count",
            F.when((F.col("row_count") > 0) & F.lit(not missing), "accepted")
            .otherwise("rejected")
            .alias("status"),
        )

    return reduce(DataFrame.unionByName, [report(t) for t in TABLES])


# -- scalar building blocks ----------------------------------------------


def cast_of(text: str, convert: Callable) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = supplied(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", F.expr(text).alias("raw")
        )
        return plain(rows.withColumn("value", convert("raw")))

    return query


def cast_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = supplied(spark, sf_dir, "orders").select("o_orderkey", F.expr(TIME_TEXT).alias("raw"))
    return plain(rows.withColumn("value", to_time("raw")))


def normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, sf_dir, "orders").select(
        "order_id",
        squash("order_status").alias("squashed"),
        strip("order_status").alias("stripped"),
    )


def delivery_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = F.expr("ts + INTERVAL '1' HOUR * (event_id % 400 - 200)")
    events = supplied(spark, sf_dir, "events").withColumn("later", later)
    return events.select("event_id", elapsed_days("ts", "later").alias("days"))


def on_time_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = supplied(spark, sf_dir, "events").withColumns(
        {
            "done": F.expr("CASE WHEN event_id % 9 <> 0 THEN ts END"),
            "due": F.expr("ts + INTERVAL '1' HOUR * (event_id % 3 - 1)"),
        }
    )
    return events.select("event_id", no_later_than("done", "due").alias("on_time"))


def money_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned money as text, which shows its scale, and its type."""
    items = silver(spark, sf_dir, "order_items")
    return items.select(
        "order_id",
        "order_item_id",
        F.col("price").cast("string").alias("price"),
        F.col("freight_value").cast("string").alias("freight_value"),
        F.typeof("price").alias("price_type"),
    )


# -- filters and dedupe --------------------------------------------------


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TABLES["customers"]
    return with_keys(typed(extract(spark, sf_dir, "customers"), spec), spec)


def filter_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TABLES["geolocation"]
    return within_ranges(typed(extract(spark, sf_dir, "geolocation"), spec), spec)


def filter_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TABLES["order_items"]
    return plain(typed(extract(spark, sf_dir, "order_items"), spec).filter(spec.rule.holds()))


def filter_isin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = Rule("status", "order_status", allowed=ORDER_STATUSES)
    orders = typed(extract(spark, sf_dir, "orders"), TABLES["orders"])
    return orders.select("order_id", "order_status", rule.holds().alias("accepted")).filter(
        F.col("accepted").isNotNull()
    )


def dedupe_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(supplied(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- cleaned, quarantined and staged tables ------------------------------


def silver_query(table: str) -> Query:
    return lambda spark, sf_dir: plain(silver(spark, sf_dir, table))


def quarantine_query(table: str, on_null: str = "drop") -> Query:
    return lambda spark, sf_dir: plain(quarantined_rows(tagged(spark, sf_dir, table, on_null)))


def staging_query(model: str) -> Query:
    return lambda spark, sf_dir: plain(stage(spark, sf_dir, model))


# -- aggregates and reporting tables -------------------------------------


def aggregate_query(aggregate: Callable[[DataFrame], DataFrame], model: str) -> Query:
    return lambda spark, sf_dir: plain(aggregate(stage(spark, sf_dir, model)))


def customers_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_customers(
        stage(spark, sf_dir, "stg_customers"), stage(spark, sf_dir, "stg_orders"), NOW
    )


def products_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_products(
        stage(spark, sf_dir, "stg_products"),
        silver(spark, sf_dir, TRANSLATION),
        stage(spark, sf_dir, "stg_order_items"),
        NOW,
    )


def orders_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fct_orders(
        stage(spark, sf_dir, "stg_orders"),
        stage(spark, sf_dir, "stg_order_payments"),
        stage(spark, sf_dir, "stg_order_items"),
    )


def fact_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(marts.fact_preview(orders_fact(spark, sf_dir)))


# -- table maintenance ---------------------------------------------------


def first_load(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("order_purchase_timestamp") < "2000-01-01")


def second_load(fact: DataFrame) -> DataFrame:
    """Overlaps the first load in one year, with other values."""
    bought = F.col("order_purchase_timestamp")
    return fact.filter((bought >= "1999-01-01") | bought.isNull()).withColumns(
        {"order_status": F.lit("delivered"), "_batch_id": F.lit("silver-2")}
    )


def stored_fact(spark: SparkSession, sf_dir: str) -> tuple[TableStore, DataFrame]:
    """The fact, computed and written once."""
    store = new_store(spark)
    store.replace("work", "fact", orders_fact(spark, sf_dir), *SILVER_RUN)
    return store, store.read("work", "fact")


def fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into a stored table: the first creates it, the second merges."""
    store, fact = stored_fact(spark, sf_dir)
    store.upsert("gold", "fct_orders", first_load(fact), ["order_id"], "silver-1", "2024-03-01")
    store.upsert("gold", "fct_orders", second_load(fact), ["order_id"], "silver-2", "2024-03-02")
    return plain(store.read("gold", "fct_orders"))


def changed_sources(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The fact's sources a day later: rows changed, added and removed in each of them."""
    number = F.col("order_id").cast("bigint")
    orders, payments, items = (tables[t] for t in incremental.SOURCES)
    closed = F.when(number % 50 == 5, "delivered").otherwise(F.col("order_status"))
    twice = F.when(number % 10 == 1, 2 * F.col("payment_value")).otherwise(F.col("payment_value"))
    dearer = F.when(number % 10 == 4, F.col("price") + 1).otherwise(F.col("price"))
    again = items.filter(number % 10 == 3).withColumn("order_item_id", F.col("order_item_id") + 100)
    found = {
        "orders": orders.withColumn("order_status", closed),
        "order_payments": payments.filter(number % 10 != 2).withColumn(
            "payment_value", twice.cast("decimal(10,2)")
        ),
        "order_items": items.withColumn("price", dearer.cast("decimal(10,2)")).unionByName(again),
    }
    run = {"_batch_id": F.lit("silver-2"), "_run_date": F.lit("2024-03-02")}
    return {t: df.withColumns(run) for t, df in found.items()}


def fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of a first day, then of a second day from the orders that have changed.

    Each source is cleaned and written once; both days start from what was written.
    """
    store = new_store(spark)
    for table in incremental.SOURCES:
        store.replace("work", table, silver(spark, sf_dir, table), *SILVER_RUN)
    cleaned = {t: store.read("work", t) for t in incremental.SOURCES}
    first = F.col("order_id").cast("bigint") % 20 != 7

    def load(tables: dict[str, DataFrame], run: tuple[str, str]) -> None:
        inputs = {t: store.replace("silver", t, df, *run).version for t, df in tables.items()}
        stored = {t: store.read("silver", t) for t in tables}
        models = {m: staging(m, stored) for m, (t, _) in STAGING.items() if t in stored}
        refresh_fact(store, models, inputs, *run)

    load(cleaned | {"orders": cleaned["orders"].filter(first)}, SILVER_RUN)
    load(changed_sources(cleaned), ("silver-2", "2024-03-02"))
    return plain(store.read("gold", "fct_orders"))


def fact_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact from cleaned tables that are clustered by order, so that its joins need no shuffle."""
    store = TableStore(spark, scratch(spark), {"silver": f"silver_{uuid.uuid4().hex}"})
    number = files_for(supplied(spark, sf_dir, "lineitem").count())
    for table in incremental.SOURCES:
        rows = tagged(spark, sf_dir, table)
        store.replace_split("silver", table, rows, *SILVER_RUN, cluster=(incremental.KEY, number))
    stored = {t: store.read("silver", t) for t in incremental.SOURCES}
    models = [staging(m, stored) for m in ("stg_orders", "stg_order_payments", "stg_order_items")]
    return plain(marts.fct_orders(*models))


def fact_upsert_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source brings a column, the target keeps one the source lacks."""
    store, fact = stored_fact(spark, sf_dir)
    target = first_load(fact).withColumn("load_no", F.lit(1).cast("bigint"))
    source = second_load(fact).withColumn("channel", F.lit("late"))
    store.upsert("gold", "fct_orders", target, ["order_id"], "silver-1", "2024-03-01")
    store.upsert("gold", "fct_orders", source, ["order_id"], "silver-2", "2024-03-02")
    return plain(store.read("gold", "fct_orders"))


def upsert_after_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load whose base is no longer the newest: another writer's load comes in between."""
    store = new_store(spark)
    orders = supplied(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    third = F.col("o_orderkey") % 3
    store.replace("silver", "orders", orders.filter(third == 0), *SILVER_RUN)
    rival = TableStore(spark, store.root)
    stale = []

    def build(now: DataFrame) -> DataFrame:
        if not stale:
            rival.upsert("silver", "orders", orders.filter(third == 1), ["o_orderkey"], "r", "d")
        stale.append(now)
        own = orders.filter(third == 2).withColumn("o_orderstatus", F.lit("late"))
        return upsert(now, own, ["o_orderkey"])

    store.change("silver", "orders", build, "run-2", "2024-03-02")
    return store.read("silver", "orders")


def fact_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files rewritten into few, same rows."""
    store = new_store(spark)
    rows = typed(extract(spark, sf_dir, "order_payments"), TABLES["order_payments"])
    store.replace("silver", "payments", rows.repartition(64), *SILVER_RUN)
    store.compact("silver", "payments")
    return plain(store.read("silver", "payments"))


def two_versions(spark: SparkSession, sf_dir: str) -> TableStore:
    store = new_store(spark)
    orders = supplied(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    store.replace("silver", "orders", orders, "run-1", "2024-03-01")
    changed = store.read("silver", "orders").withColumn("o_orderstatus", F.lit("X"))
    store.replace("silver", "orders", changed, "run-2", "2024-03-02")
    return store


def version_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_versions(spark, sf_dir).read("silver", "orders", version=1)


def version_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = two_versions(spark, sf_dir)
    store.rollback("silver", "orders", 1)
    return store.read("silver", "orders")


# -- history -------------------------------------------------------------


def in_2024(month: int) -> datetime:
    return datetime(2024, month, 1, 6, 30, 0, 125_000, tzinfo=timezone.utc)


def three_snapshots(
    spark: SparkSession, sf_dir: str, at: Callable[[int], datetime] = in_2024
) -> DataFrame:
    """Customers at three times: some move, some leave, some come back."""
    store = new_store(spark)
    store.replace("work", "customers", stage(spark, sf_dir, "stg_customers"), *SILVER_RUN)
    now = store.read("work", "customers")
    zip_code = F.col("customer_zip_code_prefix")

    def where(n: int, value, column: str):
        return F.when(zip_code % n == 0, value).otherwise(F.col(column))

    earlier = now.filter(~F.col("customer_id").like("idle-%"))
    moved = now.filter(zip_code.isNull() | (zip_code % 7 != 0)).withColumns(
        {
            "customer_city": where(5, F.lit("moved"), "customer_city"),
            "customer_state": where(6, F.lit(None), "customer_state"),
            "customer_unique_id": where(4, F.lit("other"), "customer_unique_id"),
            "customer_zip_code_prefix": F.coalesce(zip_code, F.lit(1)),
        }
    )
    for month, snapshot in enumerate((earlier, moved, now), start=1):
        keep_customers(store, snapshot, at(month))
    return store.read("gold", "dim_customers_snapshot")


def keep_customers(store: TableStore, snapshot: DataFrame, at: datetime) -> None:
    store.keep_history(
        "gold", "dim_customers_snapshot", snapshot, HISTORY_KEY, HISTORY_CHECK, "b", "d", at
    )


def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(three_snapshots(spark, sf_dir))


def customer_history_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = datetime(2024, 2, 15, tzinfo=timezone.utc)
    return plain(as_known_at(three_snapshots(spark, sf_dir), at))


def orders_with_customer_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cleaned orders with the customer as known when they were placed."""

    def at(nth: int) -> datetime:
        return datetime(1991 + 2 * nth, 6, 15, 7, tzinfo=timezone.utc)

    history = three_snapshots(spark, sf_dir, at)
    orders = stage(spark, sf_dir, "stg_orders")
    met = join_as_of(orders, history, "customer_id", "order_purchase_timestamp", "then", hot_rows=20)
    customer = ("customer_city", "customer_state", "dbt_valid_from", "dbt_valid_to")
    return plain(
        met.select(
            "order_id", "customer_id", "order_purchase_timestamp", *[f"then.{c}" for c in customer]
        )
    )


def changed_columns(before: Callable, after: Callable) -> Query:
    """A history of customers whose columns differ between two snapshots; every fifth has moved."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = new_store(spark)
        customers = supplied(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("c_nationkey").alias("customer_state"),
            F.lit(1).alias("customer_zip_code_prefix"),
            F.col("c_name").alias("note"),
        )
        moved = F.when(F.col("customer_id") % 5 == 0, "moved").otherwise(F.col("customer_city"))
        keep_customers(store, before(customers), in_2024(1))
        keep_customers(store, after(customers.withColumn("customer_city", moved)), in_2024(2))
        history = store.read("gold", "dim_customers_snapshot")
        shown = ("customer_id", "customer_city", "note", "dbt_valid_from", "dbt_valid_to")
        return plain(history.select(*shown))

    return query


def without_note(customers: DataFrame) -> DataFrame:
    return customers.drop("note")


def as_it_is(customers: DataFrame) -> DataFrame:
    return customers


# -- checks --------------------------------------------------------------


def check_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks on stored tables, counted by the writes of these tables."""
    store = new_store(spark)
    models = {table: model for model, (table, _) in STAGING.items()}

    def kept(layer: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        def keep(name: str) -> DataFrame:
            keys = TABLES[name].keys if name in TABLES else ()
            store.replace(
                layer, name, tables[name], *SILVER_RUN, checks=CHECKS.get(models.get(name, name), ()),
                unique=keys if len(keys) == 1 else (),
            )
            return store.read(layer, name)

        with ThreadPoolExecutor(max_workers=6) as pool:
            return dict(zip(tables, pool.map(inheritable_thread_target(spark)(keep), tables)))

    cleaned = kept("silver", {name: silver(spark, sf_dir, name) for name in (*models, TRANSLATION)})
    stages = {m: staging(m, cleaned) for m in STAGING}
    orders, items = stages["stg_orders"], stages["stg_order_items"]
    built = {
        "fct_orders": marts.fct_orders(orders, stages["stg_order_payments"], items),
        "dim_customers": marts.dim_customers(stages["stg_customers"], orders, NOW),
        "dim_products": marts.dim_products(
            stages["stg_products"], cleaned[TRANSLATION], items, NOW
        ),
    }
    kept("gold", built)
    counted = {model: store.counted("silver", table) for table, model in models.items()}
    counted |= {name: store.counted("gold", name) for name in built}
    return counted_results(spark, {m: (CHECKS[m], counted[m]) for m in CHECKS})


def check_results_untreated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging checks on rows that were typed but not cleaned, so that many fail."""
    results = [
        evaluate(model, typed(extract(spark, sf_dir, table), TABLES[table]), CHECKS[model])
        for model, (table, _) in STAGING.items()
    ]
    return reduce(DataFrame.unionByName, results)


def freshness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = supplied(spark, sf_dir, "events")
    loaded = {
        "orders": supplied(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("at")),
        "order_items": supplied(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("at")),
        "geolocation": events.select(F.col("ts").alias("at")),
        TRANSLATION: events.select(F.col("ts").alias("at")),
        "sellers": events.filter(F.col("value").isNull()).select(F.col("ts").alias("at")),
        "customers": supplied(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("at")),
        "products": supplied(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("at")),
        "order_payments": events.filter("value > 5").select(F.col("ts").alias("at")),
        "order_reviews": events.filter("value < 5").select(F.col("ts").alias("at")),
    }
    as_of = datetime(2024, 3, 1, tzinfo=timezone.utc)
    return plain(freshness(loaded, FRESHNESS, as_of, loaded_at="at"))


# -- runs ----------------------------------------------------------------


def write_extracts(spark: SparkSession, sf_dir: str, root: str, run_date: str) -> None:
    """All extracts, a few side by side, so that small ones do not keep the cluster waiting."""

    def write(table: str) -> None:
        write_csv(extract(spark, sf_dir, table), extract_path(root, "shop", run_date, table))

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), TABLES))


def table_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three stages from CSV extracts to reporting tables: rows per table written."""
    root = scratch(spark)
    write_extracts(spark, sf_dir, f"{root}/raw", "2024-03-01")
    store = TableStore(spark, f"{root}/tables")
    results = run_bronze(store, f"{root}/raw", "shop", "2024-03-01", "bronze-1", NOW, drop_landed=True)
    results += run_silver(store, "2024-03-01", "silver-1", NOW)
    results += run_gold(store, "2024-03-01", "gold-1", NOW)
    return results_frame(spark, results).drop("error")


def stored_table(table: str) -> Query:
    """A cleaned table as it is read back: from CSV through landing and cleansing, each stored."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        name = table.removeprefix("quarantine_")
        spec, store = TABLES[name], new_store(spark)
        path = extract_path(scratch(spark), "shop", "2024-02-29", name)
        write_csv(extract(spark, sf_dir, name), path)
        rows, file_column = read_long_extract(spark, path)
        rows = stamp_landing(rows, *BRONZE_RUN, NOW, file_column)
        store.replace("bronze", name, rows, *BRONZE_RUN, allow_empty=False)
        rows = stamped(cleanse(store.read("bronze", name), spec, "drop"), spec, *SILVER_RUN, NOW)
        if spec.rule is None:
            store.replace("silver", name, rows, *SILVER_RUN)
        else:
            store.replace_split("silver", name, rows, *SILVER_RUN)
        return plain(store.read("silver", table).drop("_ingestion_timestamp", "_source_file"))

    return query


def stored_gold(table: str) -> Query:
    """A reporting table as a whole run leaves it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch(spark)
        write_extracts(spark, sf_dir, f"{root}/raw", "2024-03-01")
        store = TableStore(spark, f"{root}/tables")
        run_bronze(store, f"{root}/raw", "shop", "2024-03-01", "bronze-1", NOW, drop_landed=True)
        run_silver(store, "2024-03-01", "silver-1", NOW)
        run_gold(store, "2024-03-01", "gold-1", NOW)
        return plain(store.read("gold", table))

    return query


def published(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """A whole run whose tables are published; the database of each layer."""
    root, own = scratch(spark), uuid.uuid4().hex
    databases = {layer: f"{layer}_{own}" for layer in ("bronze", "silver", "gold")}
    write_extracts(spark, sf_dir, f"{root}/raw", "2024-03-01")
    store = TableStore(spark, f"{root}/tables", databases)
    run_bronze(store, f"{root}/raw", "shop", "2024-03-01", "bronze-1", NOW, drop_landed=True)
    run_silver(store, "2024-03-01", "silver-1", NOW)
    run_gold(store, "2024-03-01", "gold-1", NOW)
    return databases


def published_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every view in the databases of a run, with its rows."""
    counts = []
    for layer, database in published(spark, sf_dir).items():
        for view in spark.sql(f"SHOW VIEWS IN {database}").filter("NOT isTemporary").collect():
            rows = spark.table(f"{database}.{view.viewName}").agg(F.count(F.lit(1)).alias("row_count"))
            counts.append(rows.select(F.lit(layer).alias("layer"), F.lit(view.viewName).alias("view_name"), "row_count"))
    return reduce(DataFrame.unionByName, counts)


def fact_through_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(spark.table(f"{published(spark, sf_dir)['gold']}.fct_orders"))


def results_of(stage: Callable[[], list[TableResult]]) -> list[TableResult]:
    try:
        return stage()
    except StageFailed as failed:
        return failed.results


def gate_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run with an empty extract, one without a needed column, and one that fails a check."""
    root = scratch(spark)
    store = TableStore(spark, f"{root}/tables")
    for table in TABLES:
        rows = extract(spark, sf_dir, table)
        if table == "sellers":
            rows = rows.filter("false").coalesce(1)
        elif table == "geolocation":
            rows = rows.drop(TABLES[table].contract[0])
        elif table == "customers":
            rows = rows.withColumn("customer_city", F.lit(None).cast("string"))
        write_csv(rows, extract_path(f"{root}/raw", "shop", "2024-03-01", table))
    results = results_of(
        lambda: run_bronze(store, f"{root}/raw", "shop", "2024-03-01", "b", NOW, drop_landed=True)
    )
    # The two tables that did not land are empty from here on, as on a first day without them.
    for table in ("sellers", "geolocation"):
        none = extract(spark, sf_dir, table).filter("false")
        store.replace("bronze", table, none.withColumns({"_batch_id": F.lit("b"), "_run_date": F.lit("d")}), *BRONZE_RUN)
    results += results_of(lambda: run_silver(store, "2024-03-01", "silver-1", NOW))
    results += results_of(lambda: run_gold(store, "2024-03-01", "gold-1", NOW))
    return results_frame(spark, results).select("layer", "table_name", "status")


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs recorded in the morning, then those of the afternoon over them."""
    records = supplied(spark, sf_dir, "events").select(
        F.col("event_type").alias("pipeline_name"),
        F.expr("CAST(CAST(ts AS DATE) AS STRING)").alias("run_date"),
        F.expr("CASE WHEN value < 5 THEN 'FAILED' ELSE 'SUCCEEDED' END").alias("status"),
        F.expr("CAST(event_id AS STRING)").alias("execution_arn"),
        F.expr("left(CAST(ts AS STRING), 19)").alias("started_at"),
        F.hour("ts").alias("hour"),
    )
    morning = records.filter("hour < 12").drop("hour")
    afternoon = records.filter("hour >= 12").drop("hour")
    return ledger.record(ledger.last_per_run(morning), afternoon)


def in_utc(query: Query) -> Query:
    """Times in the extracts carry no zone; they are read and shown as UTC.

    Tasks are kept small, as the library recommends.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        limit_tasks(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: in_utc(query) for name, query in _REGISTERED.items()}


_REGISTERED: dict[str, Query] = {
    "ingest_csv_roundtrip": ingest_csv_roundtrip,
    "ingest_long_csv": ingest_long_csv,
    "ingest_stamped": ingest_stamped,
    "contract_report": contract_report,
    "cast_int_legacy": cast_of(NUMBER_TEXT, to_int),
    "cast_decimal": cast_of(MONEY_TEXT, to_money),
    "cast_double": cast_of(DOUBLE_TEXT, to_double),
    "cast_timestamp": cast_timestamp,
    "normalise_text": normalise_text,
    "money_text": money_text,
    "delivery_days": delivery_days,
    "on_time_flag": on_time_flag,
    "filter_not_null": filter_not_null,
    "filter_range": filter_range,
    "filter_positive": filter_positive,
    "filter_isin": filter_isin,
    "dedupe_items": dedupe_items,
    "silver_orders": silver_query("orders"),
    "silver_customers": silver_query("customers"),
    "silver_products": silver_query("products"),
    "silver_items": silver_query("order_items"),
    "silver_payments": silver_query("order_payments"),
    "silver_reviews": silver_query("order_reviews"),
    "silver_sellers": silver_query("sellers"),
    "silver_geolocation": silver_query("geolocation"),
    "silver_translation": silver_query(TRANSLATION),
    "quarantine_orders": quarantine_query("orders"),
    "quarantine_items": quarantine_query("order_items"),
    "quarantine_payments": quarantine_query("order_payments"),
    "quarantine_reviews": quarantine_query("order_reviews"),
    "quarantine_orders_null": quarantine_query("orders", "quarantine"),
    "quarantine_payments_null": quarantine_query("order_payments", "quarantine"),
    "stg_orders": staging_query("stg_orders"),
    "stg_customers": staging_query("stg_customers"),
    "stg_products": staging_query("stg_products"),
    "stg_items": staging_query("stg_order_items"),
    "stg_payments": staging_query("stg_order_payments"),
    "customer_order_stats": aggregate_query(marts.orders_per_customer, "stg_orders"),
    "product_sales": aggregate_query(marts.sales_per_product, "stg_order_items"),
    "order_payments_agg": aggregate_query(marts.payments_per_order, "stg_order_payments"),
    "order_items_agg": aggregate_query(marts.items_per_order, "stg_order_items"),
    "dim_customers": lambda spark, sf_dir: plain(customers_dimension(spark, sf_dir)),
    "dim_products": lambda spark, sf_dir: plain(products_dimension(spark, sf_dir)),
    "fct_orders": lambda spark, sf_dir: plain(orders_fact(spark, sf_dir)),
    "fact_preview": fact_preview,
    "fact_upsert": fact_upsert,
    "fact_upsert_new_column": fact_upsert_new_column,
    "upsert_after_conflict": upsert_after_conflict,
    "fct_orders_incremental": fact_incremental,
    "fct_orders_clustered": fact_clustered,
    "fact_compacted": fact_compacted,
    "version_read": version_read,
    "version_rollback": version_rollback,
    "customer_history": customer_history,
    "customer_history_as_of": customer_history_as_of,
    "orders_with_customer_as_of": orders_with_customer_as_of,
    "history_column_added": changed_columns(without_note, as_it_is),
    "history_column_removed": changed_columns(as_it_is, without_note),
    "check_results": check_results,
    "check_results_untreated": check_results_untreated,
    "freshness": freshness_report,
    "table_results": table_results,
    "gate_results": gate_results,
    "published_views": published_views,
    "fact_through_view": fact_through_view,
    "run_ledger": run_ledger,
    **{f"stored_{t}": stored_table(t) for t in STORED},
    **{f"stored_{t}": stored_gold(t) for t in STORED_GOLD},
}
