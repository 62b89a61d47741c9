"""Landed text tables to typed, filtered, deduplicated and split tables.

Order of work for every table: types and text clean-up, key filters, range
filters, dedupe, split, stamp.  A table with a rule stays one frame that carries
its outcome per row, so that scan and shuffle run once for both outputs.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from siltworks.functions.casts import squash, strip, to_double, to_int, to_money, to_time
from siltworks.functions.measures import moment
from siltworks.operators.dedupe import first_per_key
from siltworks.specs import GOOD, QUARANTINE, TableSpec

OUTCOME = "outcome"
STAMP = "_silver_timestamp"
QUARANTINE_COLUMNS = ("quarantine_reason", "quarantined_at")


def typed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast and normalise the named columns in place; others pass through."""
    converters = (
        (to_int, spec.ints),
        (to_double, spec.doubles),
        (to_money, spec.money),
        (to_time, spec.times),
        (squash, spec.squashed),
        (strip, spec.stripped),
    )
    return df.withColumns({c: convert(c) for convert, cols in converters for c in cols})


def with_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Drop rows where a required value is NULL.

    Spelled as single conditions, which the Parquet scan takes over.
    """
    return df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in spec.not_null]))


def within_ranges(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keep rows inside all inclusive bounds; NULL and NaN are outside."""
    bounds = [F.col(c).between(*limits) for c, limits in spec.ranges.items()]
    return df.filter(reduce(Column.__and__, bounds)) if bounds else df


def cleanse(df: DataFrame, spec: TableSpec, on_null: str = "drop") -> DataFrame:
    """Clean rows of one table, with an ``outcome`` column if it has a rule.

    ``on_null`` says what happens to a row whose tested column is NULL:
    ``"drop"`` leaves it out of both outputs, ``"quarantine"`` keeps it aside.
    """
    if on_null not in ("drop", "quarantine"):
        raise ValueError(f"on_null must be 'drop' or 'quarantine', not {on_null!r}")
    rows = within_ranges(with_keys(typed(df, spec), spec), spec)
    if spec.rule is None:
        return first_per_key(rows, spec.keys)
    tagged = rows.withColumn(OUTCOME, spec.rule.outcome(on_null))
    if spec.rule.splits_first:
        survivors = first_per_key(tagged, (*spec.keys, OUTCOME))
    else:
        survivors = first_per_key(tagged, spec.keys)
    every_row_has_one = (
        on_null == "quarantine" or spec.rule.null_is_invalid or spec.rule.column in spec.not_null
    )
    return survivors if every_row_has_one else survivors.filter(F.col(OUTCOME).isNotNull())


def stamped(
    clean: DataFrame,
    spec: TableSpec,
    batch_id: str,
    run_date: str,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """Add run metadata in one frame for both outputs.

    Good rows get this run's batch and date in place of the landing run's;
    quarantined rows keep the landing run's values and get reason and time.
    """
    now = moment(as_of)
    if spec.rule is None:
        return clean.withColumns(
            {STAMP: now, "_batch_id": F.lit(batch_id), "_run_date": F.lit(run_date)}
        )
    good = F.col(OUTCOME) == GOOD
    landed = {c: F.col(c) if c in clean.columns else F.lit(None).cast("string")
              for c in ("_batch_id", "_run_date")}
    return clean.withColumns(
        {
            STAMP: F.when(good, now),
            "_batch_id": F.when(good, F.lit(batch_id)).otherwise(landed["_batch_id"]),
            "_run_date": F.when(good, F.lit(run_date)).otherwise(landed["_run_date"]),
            "quarantine_reason": F.when(~good, F.lit(spec.rule.reason)),
            "quarantined_at": F.when(~good, now),
        }
    )


def good_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c != OUTCOME and c not in QUARANTINE_COLUMNS]


def quarantine_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c not in (OUTCOME, STAMP)]


def good_rows(tagged: DataFrame) -> DataFrame:
    if OUTCOME not in tagged.columns:
        return tagged
    return tagged.filter(F.col(OUTCOME) == GOOD).select(*good_columns(tagged.columns))


def quarantined_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(OUTCOME) == QUARANTINE).select(
        *quarantine_columns(tagged.columns)
    )
