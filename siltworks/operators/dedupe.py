"""One row per key, the same row on every run."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_rank_in_key"
_COUNT = "_rows_in_key"


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Iterable[Column] | None = None
) -> DataFrame:
    """Keep the first row of each key; NULL key parts count as equal.

    Without ``order`` all other columns, in schema order and NULLs last, decide,
    so that the survivor does not depend on task order.  Spark keeps one row per
    key and map task before the shuffle (WindowGroupLimit), so a hot key sends
    at most one row per input partition to its reducer.
    """
    if order is None:
        order = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    order = list(order) or [F.col(c) for c in keys]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> DataFrame:
    """Pass rows through, failing the running query if a key has several rows.

    The check is part of the plan: no extra job, and neither a shuffle nor a sort
    of its own when ``df`` comes out of a sort-merge join on ``keys``.
    """
    message = F.lit(f"{what} has more than one row for a key of ({', '.join(keys)})")
    guarded = df.withColumn(_COUNT, F.count(F.lit(1)).over(Window.partitionBy(*keys))).filter(
        F.when(F.col(_COUNT) == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    )
    return guarded.drop(_COUNT)
