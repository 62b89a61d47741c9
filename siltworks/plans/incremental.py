"""The order fact from what has changed: only orders with other orders, payments or items rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from siltworks.operators.changes import changed_keys
from siltworks.plans.marts import fct_orders

KEY = "order_id"
# The cleaned tables that the fact is made of.
SOURCES = ("orders", "order_payments", "order_items")
# Columns that tell of a run, not of an order; they alone do not make an order a changed one.
RUN_COLUMNS = ("_run_date", "_batch_id", "_silver_timestamp", "_ingestion_timestamp", "_source_file")


def affected_orders(
    before: Mapping[str, DataFrame], after: Mapping[str, DataFrame]
) -> DataFrame:
    """Ids of orders with other rows in any of the tables given, each once.

    Tables that have not changed can be left out of both.
    """
    changed = [changed_keys(before[t], after[t], KEY, RUN_COLUMNS) for t in SOURCES if t in after]
    return reduce(DataFrame.unionByName, changed).distinct()


def fact_of(
    affected: DataFrame, orders: DataFrame, payments: DataFrame, items: DataFrame
) -> DataFrame:
    """Fact rows of the affected orders that there still are; no others are aggregated or joined."""
    own = (df.join(affected, KEY, "left_semi") for df in (orders, payments, items))
    return fct_orders(*own)
