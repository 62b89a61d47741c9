"""Keyed upsert as a pure function: old table and new rows in, new table out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siltworks.operators.dedupe import require_unique

_IN_SOURCE = "_in_source"
_IN_TARGET = "_in_target"


def on_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"{left}.{key}") == F.col(f"{right}.{key}"))
    return condition


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], inserted: str | None = None
) -> DataFrame:
    """Update matched rows, insert new ones, keep the rest.

    Columns only in ``source`` are appended (NULL on rows it does not touch);
    columns only in ``target`` keep their values.  A key that occurs twice in
    ``source`` fails the query.  One full outer join: a source that comes out of
    joins on the same keys is not shuffled again.  ``inserted`` names a further column that is
    true on new rows.
    """
    fresh = require_unique(source, keys).withColumn(_IN_SOURCE, F.lit(True))
    known = target.withColumn(_IN_TARGET, F.lit(True))
    joined = known.alias("t").join(fresh.alias("s"), on_keys("t", "s", keys), "full_outer")
    touched = F.col(f"s.{_IN_SOURCE}").isNotNull()

    columns = []
    for f in target.schema.fields:
        if f.name in source.columns:
            new = F.col(f"s.{f.name}").cast(f.dataType)
            columns.append(F.when(touched, new).otherwise(F.col(f"t.{f.name}")).alias(f.name))
        else:
            columns.append(F.col(f"t.{f.name}"))
    columns += [F.col(f"s.{c}") for c in source.columns if c not in target.columns]
    if inserted is not None:
        columns.append(F.col(f"t.{_IN_TARGET}").isNull().alias(inserted))
    return joined.select(*columns)
