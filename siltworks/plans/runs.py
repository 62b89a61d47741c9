"""The three stages and the run that chains them.

A stage works table by table: one failing table is recorded and does not stop
the others, whose new versions stay committed; the stage raises at the end.
Tables are independent jobs, so a few are submitted side by side and Spark
shares the executors among them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, types as T

from siltworks.operators import ledger
from siltworks.operators.cleanse import cleanse, stamped
from siltworks.operators.quality import evaluate, freshness
from siltworks.plans import incremental, marts
from siltworks.plans.checks import CHECKS, FRESHNESS
from siltworks.plans.staging import STAGING, staging
from siltworks.sources.extracts import check_contract, extract_path, stamp_landing
from siltworks.sources.long_files import read_long_extract
from siltworks.sources.shared_files import delete
from siltworks.sources.store import TableStore
from siltworks.specs import TABLES

BRONZE, SILVER, GOLD, OPS = "bronze", "silver", "gold", "ops"
DATABASES = {BRONZE: "bronze_db", SILVER: "silver_db", GOLD: "gold_db", OPS: "ops_db"}

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("quarantined", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


@dataclass(frozen=True)
class TableResult:
    layer: str
    table_name: str
    status: str
    row_count: int | None = None
    quarantined: int | None = None
    error: str | None = None


class StageFailed(RuntimeError):
    def __init__(self, stage: str, results: list[TableResult]):
        self.results = results
        bad = [f"{r.table_name} ({r.status}): {r.error}" for r in results if r.status != "succeeded"]
        super().__init__(f"{stage} failed for {len(bad)} of {len(results)}: " + "; ".join(bad))


def new_batch_id() -> str:
    return str(uuid.uuid4())


def results_frame(spark: SparkSession, results: Iterable[TableResult]) -> DataFrame:
    return spark.createDataFrame([asdict(r) for r in results], RESULT_SCHEMA)


def _each_table(
    spark: SparkSession,
    layer: str,
    names: Iterable[str],
    build: Callable[[str], TableResult],
    side_by_side: int,
) -> list[TableResult]:
    def isolated(name: str) -> TableResult:
        try:
            return build(name)
        except Exception as error:  # recorded per table, raised by the stage
            return TableResult(layer, name, "failed", error=str(error))

    with ThreadPoolExecutor(max_workers=side_by_side) as pool:
        return list(pool.map(inheritable_thread_target(spark)(isolated), names))


def _raise_if_failed(stage: str, results: list[TableResult]) -> list[TableResult]:
    if any(r.status != "succeeded" for r in results):
        raise StageFailed(stage, results)
    return results


def run_bronze(
    store: TableStore, raw_root: str, source: str, run_date: str,
    batch_id: str | None = None, as_of: datetime | None = None, side_by_side: int = 4,
    drop_landed: bool = False,
) -> list[TableResult]:
    """Land the nine extracts of one run date, files of any length in blocks.

    With ``drop_landed`` an extract is removed once its table is committed, as for one that was
    written for this run alone; an extract that does not land stays.
    """
    batch_id = batch_id or new_batch_id()

    def land(name: str) -> TableResult:
        path = extract_path(raw_root, source, run_date, name)
        extract, file_column = read_long_extract(store.spark, path)
        extract = check_contract(extract, TABLES[name])
        rows = stamp_landing(extract, batch_id, run_date, as_of, file_column)
        commit = store.replace(BRONZE, name, rows, batch_id, run_date, allow_empty=False)
        if drop_landed:
            delete(store.spark, [path])
        return TableResult(BRONZE, name, "succeeded", commit.rows)

    return _raise_if_failed(
        BRONZE, _each_table(store.spark, BRONZE, TABLES, land, side_by_side)
    )


def files_for(rows: int) -> int:
    """How many files or folders rows are dealt to by a key: a power of two, a million rows each."""
    return max(8, 1 << max(0, rows // 1_000_000).bit_length())


def run_silver(
    store: TableStore, run_date: str, batch_id: str | None = None,
    as_of: datetime | None = None, on_null: str = "drop", side_by_side: int = 4,
) -> list[TableResult]:
    """Clean the nine landed tables, each in one pass, which also counts what the checks look for.

    The tables that the fact joins are clustered by the order, all to the same number of files.
    """
    batch_id = batch_id or new_batch_id()
    number = files_for(max(store.rows_of(BRONZE, name) or 0 for name in incremental.SOURCES))
    models = {table: model for model, (table, _) in STAGING.items()}

    def clean(name: str) -> TableResult:
        spec = TABLES[name]
        rows = cleanse(store.read(BRONZE, name), spec, on_null)
        rows = stamped(rows, spec, batch_id, run_date, as_of)
        how = {
            "checks": CHECKS.get(models.get(name), ()),
            # The dedupe leaves one row of a key, so a key of one column has no value twice.
            "unique": spec.keys if len(spec.keys) == 1 else (),
            "cluster": (incremental.KEY, number) if name in incremental.SOURCES else None,
        }
        if spec.rule is None:
            commit = store.replace(SILVER, name, rows, batch_id, run_date, **how)
            return TableResult(SILVER, name, "succeeded", commit.rows)
        good, bad = store.replace_split(SILVER, name, rows, batch_id, run_date, **how)
        return TableResult(SILVER, name, "succeeded", good.rows, bad.rows)

    return _raise_if_failed(
        SILVER, _each_table(store.spark, SILVER, TABLES, clean, side_by_side)
    )


TRANSLATION = "product_category_name_translation"

# Which staging models a gold table is built from.
BUILT_FROM = {
    "dim_customers": ("stg_customers", "stg_orders"),
    "dim_products": ("stg_products", "stg_order_items"),
    "fct_orders": ("stg_orders", "stg_order_payments", "stg_order_items"),
    "dim_customers_snapshot": ("stg_customers",),
}
HISTORY_KEY = "customer_id"
HISTORY_CHECK = ("customer_city", "customer_state", "customer_zip_code_prefix")


def _failures(store: TableStore, layer: str, table: str, model: str, commit=None) -> str | None:
    """Failing checks of error severity on a model, in words; None if there are none.

    What the write of the table has counted is not counted again.
    """
    checks = CHECKS[model]
    counted = store.counted(layer, table) if commit is None else commit.checks
    if counted is None or any(c.name not in counted for c in checks):
        rows = store.read(layer, table)
        found = evaluate(model, staging(model, {table: rows}) if model in STAGING else rows, checks)
        counted = {f"{r.column_name} {r.test}": r.failures for r in found.collect()}
    bad = [f"{c.name}: {counted[c.name]}" for c in checks if c.severity == "error" and counted[c.name]]
    return ", ".join(bad) or None


def refresh_fact(
    store: TableStore, stage: dict[str, DataFrame], inputs: dict[str, int] | None,
    batch_id: str, run_date: str, refresh: str = "changed",
):
    """Upsert fact rows of all orders, or of those that differ from what the fact was built from.

    The latter if ``inputs``, the versions of the cleaned tables that ``stage`` shows, and those the
    fact was last built from are known and still there.  The ids of changed orders are kept as a
    table, so that they are found once.
    """
    sources = [stage[m] for m in ("stg_orders", "stg_order_payments", "stg_order_items")]
    known = store.inputs_of(GOLD, "fct_orders") if refresh == "changed" and inputs else None
    if known and all(store.has_version(SILVER, t, known.get(t)) for t in inputs):
        model = {table: m for m, (table, _) in STAGING.items()}
        changed = [t for t in inputs if not store.same_rows(SILVER, t, known[t], inputs[t])]
        ids = store.spark.createDataFrame([], f"{incremental.KEY} string")
        if changed:
            before = {t: staging(model[t], {t: store.read(SILVER, t, known[t])}) for t in changed}
            ids = incremental.affected_orders(before, {t: stage[model[t]] for t in changed})
        store.replace(OPS, "changed_orders", ids, batch_id, run_date)
        rows = incremental.fact_of(store.read(OPS, "changed_orders"), *sources)
    else:
        rows = marts.fct_orders(*sources)
    return store.upsert(
        GOLD, "fct_orders", rows, [incremental.KEY], batch_id, run_date,
        buckets=files_for(store.rows_of(SILVER, "orders") or 0), checks=CHECKS["fct_orders"],
        inputs=inputs,
    )


def run_gold(
    store: TableStore, run_date: str, batch_id: str | None = None,
    as_of: datetime | None = None, side_by_side: int = 4, refresh: str = "changed",
) -> list[TableResult]:
    """Look at the checks of staging, build what passes, look at the checks of the result.

    A staging model that fails a check stops the gold tables built from it.  With ``refresh``
    "changed" fact rows are computed for orders that differ from those the fact was last built
    from, with "full" for all; either way they are upserted.
    """
    if refresh not in ("changed", "full"):
        raise ValueError(f"refresh must be 'changed' or 'full', not {refresh!r}")
    batch_id = batch_id or new_batch_id()
    as_of = as_of or datetime.now(timezone.utc)
    inputs = {t: store.version_of(SILVER, t) for t in incremental.SOURCES}
    inputs = inputs if all(inputs.values()) else None
    silver = {
        name: store.read(SILVER, name, inputs and inputs.get(name))
        for name in (*(table for table, _ in STAGING.values()), TRANSLATION)
    }
    stage = {model: staging(model, silver) for model in STAGING}
    for model, (table, columns) in STAGING.items():
        store.publish_projection(GOLD, model, SILVER, table, columns)
    looked = {model: _failures(store, SILVER, table, model) for model, (table, _) in STAGING.items()}
    failing = {model: text for model, text in looked.items() if text}

    def build(name: str) -> TableResult:
        blocked = {m: failing[m] for m in BUILT_FROM[name] if m in failing}
        if blocked:
            return TableResult(GOLD, name, "skipped", error=f"failing checks: {blocked}")
        checks = CHECKS.get(name, ())
        if name == "dim_customers":
            rows = marts.dim_customers(stage["stg_customers"], stage["stg_orders"], as_of)
            commit = store.replace(GOLD, name, rows, batch_id, run_date, checks=checks)
        elif name == "dim_products":
            rows = marts.dim_products(
                stage["stg_products"], silver[TRANSLATION], stage["stg_order_items"], as_of
            )
            commit = store.replace(GOLD, name, rows, batch_id, run_date, checks=checks)
        elif name == "fct_orders":
            commit = refresh_fact(store, stage, inputs, batch_id, run_date, refresh)
            store.compact(GOLD, name)
        else:
            commit = store.keep_history(
                GOLD, name, stage["stg_customers"], HISTORY_KEY, HISTORY_CHECK,
                batch_id, run_date, as_of,
            )
        found = _failures(store, GOLD, name, name, commit) if checks else None
        if found:
            return TableResult(GOLD, name, "failed", commit.rows, error=found)
        return TableResult(GOLD, name, "succeeded", commit.rows)

    return _raise_if_failed(
        GOLD, _each_table(store.spark, GOLD, BUILT_FROM, build, side_by_side)
    )


def source_freshness(store: TableStore, as_of: datetime) -> DataFrame:
    """Age of every cleaned table against its limits."""
    return freshness({name: store.read(SILVER, name) for name in TABLES}, FRESHNESS, as_of)


def record_run(
    store: TableStore, pipeline_name: str, run_date: str, status: str,
    execution: str, started_at: datetime,
) -> None:
    """Put one run into the ledger table."""
    row = (pipeline_name, run_date, status, execution, started_at.isoformat())
    record = store.spark.createDataFrame([row], ledger.SCHEMA)
    store.change(
        OPS, "run_ledger", lambda now: record if now is None else ledger.record(now, record),
        execution, run_date,
    )


def run_all(
    store: TableStore, raw_root: str, source: str, run_date: str, pipeline_name: str,
    as_of: datetime | None = None, on_null: str = "drop", side_by_side: int = 4,
) -> list[TableResult]:
    """Bronze, silver, gold in order, then the run record, whether or not it failed."""
    execution, started_at = new_batch_id(), datetime.now(timezone.utc)
    status = "FAILED"
    try:
        results = run_bronze(store, raw_root, source, run_date, None, as_of, side_by_side)
        results += run_silver(store, run_date, None, as_of, on_null, side_by_side)
        results += run_gold(store, run_date, None, as_of, side_by_side=side_by_side)
        status = "SUCCEEDED"
        return results
    finally:
        try:
            record_run(store, pipeline_name, run_date, status, execution, started_at)
        except Exception as error:  # a missing record must not change the outcome
            print(f"run record not written: {error}")
