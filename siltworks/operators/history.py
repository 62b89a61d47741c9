"""Type-2 history: one row per version of a key, open while ``dbt_valid_to`` is NULL."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from siltworks.functions.measures import moment
from siltworks.operators.dedupe import require_unique
from siltworks.operators.upsert import on_keys

# Version columns that readers of the history table expect.
VERSION_ID = "dbt_scd_id"
UPDATED_AT = "dbt_updated_at"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
VERSION_COLUMNS = (VERSION_ID, UPDATED_AT, VALID_FROM, VALID_TO)


def version_id(key: Column, at: Column) -> Column:
    """md5 of key and time, the time always with six fractional digits."""
    text = F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("")), text))


def _opened(df: DataFrame, key: str, now: Column) -> DataFrame:
    return df.select(
        *df.columns,
        version_id(F.col(key), now).alias(VERSION_ID),
        now.alias(UPDATED_AT),
        now.alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO),
    )


def _same_columns(history: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with the columns of either, those of the history first; new ones are NULL."""
    kept = [f for f in history.schema.fields if f.name not in VERSION_COLUMNS]
    known = {f.name for f in kept}
    gained = [f for f in source.schema.fields if f.name not in known]
    lost = [f for f in kept if f.name not in source.columns]
    history = history.select(
        *[f.name for f in kept],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in gained],
        *VERSION_COLUMNS,
    )
    missing = {f.name: F.lit(None).cast(f.dataType) for f in lost}
    source = source.withColumns(missing) if missing else source
    return history, source.select(*[f.name for f in kept + gained])


def merge_history(
    history: DataFrame | None,
    source: DataFrame,
    key: str,
    check: Sequence[str],
    as_of: datetime | Column | None = None,
    close_missing: bool = True,
    earlier: DataFrame | None = None,
    newest: Column | None = None,
) -> DataFrame:
    """Next state of the history after seeing ``source`` at ``as_of``.

    A version is closed when a ``check`` column differs (NULL-safe) or, with
    ``close_missing``, when its key is gone.  Changed, new and returning keys
    get an open version.  Only open versions are joined; closed ones pass by
    without a shuffle, or not at all if they are given apart as ``earlier``, or left
    out where ``newest`` tells the newest time in the history.

    The result has the columns of both sides: one that the source has lost keeps
    the values of versions so far and is NULL on new ones, and one that it has
    gained is NULL on versions so far.  A change at a time that is not later than
    all times in the history fails the query; a rerun without changes does not.
    """
    now = moment(as_of)
    source = require_unique(source, [key])
    if history is None:
        return _opened(source, key, now)

    if newest is None:
        times = history.select(VALID_FROM, VALID_TO)
        if earlier is not None:
            times = times.unionByName(earlier.select(VALID_FROM, VALID_TO))
        newest = times.agg(F.max(F.greatest(VALID_FROM, VALID_TO))).scalar()
    history, source = _same_columns(history, source)
    still_open = history.filter(F.col(VALID_TO).isNull())
    closed = history.filter(F.col(VALID_TO).isNotNull())

    old = still_open.withColumn("_known", F.lit(True)).alias("h")
    new = source.withColumn("_seen", F.lit(True)).alias("s")
    known, seen = F.col("h._known").isNotNull(), F.col("s._seen").isNotNull()
    differs = reduce(
        Column.__or__, [~F.col(f"h.{c}").eqNullSafe(F.col(f"s.{c}")) for c in check], F.lit(False)
    )
    changed = known & seen & differs
    ends = (changed | ~seen) if close_missing else changed

    carried = F.struct(
        *[F.col(f"h.{c}").alias(c) for c in source.columns],
        *[F.col(f"h.{c}").alias(c) for c in VERSION_COLUMNS[:-1]],
        F.when(ends, now).alias(VALID_TO),
    )
    opened = F.struct(
        *[F.col(f"s.{c}").alias(c) for c in source.columns],
        version_id(F.col(f"s.{key}"), now).alias(VERSION_ID),
        now.alias(UPDATED_AT),
        now.alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO),
    )
    versions = F.array_compact(
        F.array(F.when(known, carried), F.when(seen & (~known | changed), opened))
    )
    late = (ends | (seen & ~known)) & (now <= newest)
    refused = F.raise_error(F.lit("history: a change at a time that is not later than the newest"))
    checked = F.when(late, refused).otherwise(versions)
    current = old.join(new, on_keys("h", "s", [key]), "full_outer").select(F.inline(checked))
    return closed.select(*current.columns).unionByName(current)


def history_changes(
    history: DataFrame,
    source: DataFrame,
    key: str,
    check: Sequence[str],
    as_of: datetime | Column,
    close_missing: bool = True,
) -> DataFrame:
    """The versions that ``merge_history`` ends or opens, without those it leaves alone.

    Merged by version id into the old history they give the new one, so a
    catalog with a merge need not rewrite old versions.
    """
    still_open = history.filter(F.col(VALID_TO).isNull())
    ended = history.filter(F.col(VALID_TO).isNotNull())
    after = merge_history(still_open, source, key, check, as_of, close_missing, earlier=ended)
    return after.filter(F.col(VALID_TO).isNotNull() | (F.col(VALID_FROM) == moment(as_of)))


def as_known_at(history: DataFrame, at: datetime | Column) -> DataFrame:
    """Versions valid at a point in time."""
    at = moment(at)
    return history.filter(
        (F.col(VALID_FROM) <= at) & (F.col(VALID_TO).isNull() | (at < F.col(VALID_TO)))
    )
