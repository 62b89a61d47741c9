from datetime import datetime, timedelta, timezone

import pytest

from siltworks.operators.quality import (
    ACCEPTED, EXPRESSION, NOT_NULL, UNIQUE, Check, CheckFailed, evaluate, freshness, require_passing,
)
from siltworks.plans.checks import CHECKS, FRESHNESS
from siltworks.specs import TABLES


def results(df, *checks):
    return [(r.test, r.failures, r.status) for r in evaluate("m", df, checks).collect()]


def test_checks_on_nulls_and_copies(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", -1), (None, None), (None, 3), ("b", 0)], "k string, n int"
    )
    assert sorted(results(
        df, Check("k", NOT_NULL), Check("k", UNIQUE), Check("k", ACCEPTED, allowed=("a",)),
        Check("n", EXPRESSION, expression=">= 0"), Check("k", ACCEPTED, allowed=("b",), severity="warn"),
    )) == [
        ("accepted_values", 1, "error"), ("accepted_values", 2, "warn"),
        ("expression_is_true(>= 0)", 1, "error"), ("not_null", 2, "error"), ("unique", 1, "error"),
    ]


def test_checks_without_unique_and_with_two(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x")], "k string, j string")
    assert results(df, Check("k", NOT_NULL)) == [("not_null", 0, "pass")]
    assert sorted(results(df, Check("k", UNIQUE), Check("j", UNIQUE), Check("j", NOT_NULL))) == [
        ("not_null", 0, "pass"), ("unique", 0, "pass"), ("unique", 1, "error"),
    ]


def test_empty_model_passes(spark):
    df = spark.createDataFrame([], "k string")
    assert sorted(results(df, Check("k", NOT_NULL), Check("k", UNIQUE))) == [
        ("not_null", 0, "pass"), ("unique", 0, "pass"),
    ]


def test_gate_raises_on_errors_only(spark):
    df = spark.createDataFrame([("a",), ("z",)], "k string")
    warn = Check("k", ACCEPTED, allowed=("a",), severity="warn")
    require_passing(evaluate("m", df, [warn]))
    with pytest.raises(CheckFailed, match="m.k accepted_values: 1"):
        require_passing(evaluate("m", df, [Check("k", ACCEPTED, allowed=("a",))]))


def test_the_checks_are_complete():
    sizes = {m: len(c) for m, c in CHECKS.items()}
    assert sum(sizes.values()) == 38
    assert sizes == {
        "stg_orders": 5, "stg_customers": 5, "stg_products": 6, "stg_order_items": 6,
        "stg_order_payments": 5, "fct_orders": 6, "dim_customers": 3, "dim_products": 2,
    }
    assert set(FRESHNESS) == set(TABLES)


@pytest.mark.parametrize(
    "hours, status", [(23, "pass"), (24, "pass"), (25, "warn"), (48, "warn"), (49, "error"), (None, "error")]
)
def test_freshness(spark, hours, status):
    now = datetime(2024, 3, 1, tzinfo=timezone.utc)
    rows = [] if hours is None else [(now - timedelta(hours=hours),), (now - timedelta(days=90),)]
    df = spark.createDataFrame(rows, "_silver_timestamp timestamp")
    assert freshness({"orders": df}, FRESHNESS, now).first().status == status
