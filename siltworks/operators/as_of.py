"""Each row with the version of another table that was valid at its time."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltworks.operators.history import VALID_FROM, VALID_TO

# Rows of a key from which on they are split by time.
HOT_ROWS = 1_000_000
# Most slices that a key's rows are split into.
MOST_SLICES = 1024


def _cuts(facts: DataFrame, key: str, at: str, hot_rows: int) -> tuple[DataFrame | None, int]:
    """Times that cut the rows of each hot key into slices of about ``hot_rows``, and how many keys.

    None if no key is hot.
    """
    per_key = facts.groupBy(F.col(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("n"))
    hot = per_key.filter(F.col("n") > hot_rows)
    keys, most = hot.agg(F.count(F.lit(1)), F.max("n")).first()
    if not keys:
        return None, 0
    slices = min(MOST_SLICES, max(2, math.ceil(most / hot_rows)))
    shares = [k / slices for k in range(1, slices)]
    micros = F.percentile_approx(F.unix_micros(at), shares, 10 * slices)
    own = facts.join(hot.select("hot_key"), F.col(key) == F.col("hot_key"), "left_semi")
    found = own.groupBy(F.col(key).alias("hot_key")).agg(F.array_distinct(micros).alias("cuts"))
    return found, keys


def _slice(cuts: Column, time: Column) -> Column:
    """Which slice a time falls into: the number of cuts before it."""
    return F.coalesce(F.size(F.filter(cuts, lambda c: c < F.unix_micros(time))), F.lit(0))


def join_as_of(
    facts: DataFrame, versions: DataFrame, key: str, at: str, out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All rows of ``facts`` and, as a struct ``out``, the version of their key valid at time ``at``.

    A version is valid from ``dbt_valid_from`` on and before ``dbt_valid_to``, without end if that is
    NULL; those of a key do not overlap.  ``out`` is NULL where none was valid, and for rows without
    key or time.

    Rows and versions of a key are put in one order by time, and a row takes the last version before
    it: nothing is multiplied, however many versions a key has.  A key with more than ``hot_rows``
    rows is cut into slices of time, by its own quantiles; a version goes to each slice that it is
    valid in, so no task gets all rows of the key unless they have one time.
    """
    placed = facts.select(
        F.struct("*").alias("fact"), F.col(key).alias("key"), F.col(at).cast("timestamp").alias("time")
    )
    complete = F.col("key").isNotNull() & F.col("time").isNotNull()
    version = versions.filter(F.col(key).isNotNull()).select(
        F.struct("*").alias("version"), F.col(key).alias("key"), F.col(VALID_FROM).cast("timestamp").alias("time")
    )
    events = placed.filter(complete)
    cuts, keys = _cuts(events.select(F.col("key").alias(key), F.col("time").alias(at)), key, at, hot_rows)
    if cuts is None:
        events, version = (df.withColumn("slice", F.lit(0)) for df in (events, version))
    else:
        cuts = F.broadcast(cuts) if keys <= 10_000 else cuts
        events, version = (
            df.join(cuts, F.col("key") == F.col("hot_key"), "left") for df in (events, version)
        )
        events = events.withColumn("slice", _slice(F.col("cuts"), F.col("time")))
        until = F.col(f"version.{VALID_TO}")
        last = F.when(until.isNull(), F.coalesce(F.size("cuts"), F.lit(0))).otherwise(
            _slice(F.col("cuts"), until)
        )
        first = _slice(F.col("cuts"), F.col("time"))
        valid = F.when(last >= first, F.sequence(first, last)).otherwise(F.array(first))
        version = version.withColumn("slice", F.explode(valid))
    kinds = (dict(events.dtypes)["fact"], dict(version.dtypes)["version"])
    both = events.select(
        "key", "slice", "time", F.lit(1).alias("kind"), "fact", F.lit(None).cast(kinds[1]).alias("version")
    ).unionByName(
        version.select(
            "key", "slice", "time", F.lit(0).alias("kind"), F.lit(None).cast(kinds[0]).alias("fact"), "version"
        )
    )
    # A version that begins at the time of a row is valid for it.
    order = Window.partitionBy("key", "slice").orderBy("time", "kind")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = both.withColumn("version", F.last("version", ignorenulls=True).over(upto)).filter("kind = 1")
    until = F.col(f"version.{VALID_TO}")
    found = F.when(until.isNull() | (F.col("time") < until), F.col("version"))
    rest = placed.filter(~complete).select("fact", F.lit(None).cast(kinds[1]).alias("version"))
    return (
        met.select("fact", found.alias("version"))
        .unionByName(rest)
        .select("fact.*", F.col("version").alias(out))
    )
