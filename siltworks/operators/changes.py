"""Which keys have other rows in one version of a table than in another."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def _row_hashes(df: DataFrame, ignore: Iterable[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row, in which a NULL differs from an absent column's value."""
    left_out = set(ignore)
    columns = [c for c in sorted(df.columns) if c not in left_out]
    # A hash function passes over NULLs, so where they are is hashed too.
    parts = [F.concat_ws(",", *[F.lit(c) for c in columns])]
    parts += [F.col(c) for c in columns] + [F.col(c).isNull() for c in columns]
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def digests(df: DataFrame, key: str, ignore: Iterable[str] = ()) -> DataFrame:
    """(key, digest): one row per key that stands for all its rows, in any order, repeats included.

    Reduced before its shuffle; files clustered by the key need none.
    """
    first, second = _row_hashes(df, ignore)
    digest = F.struct(
        F.count(F.lit(1)).alias("rows"),
        F.sum(first.cast("decimal(20,0)")).alias("total"),
        F.bit_xor(second).alias("mixed"),
    )
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(digest.alias("digest"))


def changed_keys(
    before: DataFrame, after: DataFrame, key: str, ignore: Iterable[str] = ()
) -> DataFrame:
    """Keys whose rows differ: changed, added, removed, or repeated another number of times.

    Columns in ``ignore`` do not count, a column that one side lacks does.  Rows without a key are
    not looked at.  Rows are compared by 128 bits of hashes.
    """
    old, new = digests(before, key, ignore), digests(after, key, ignore)
    both = old.alias("b").join(new.alias("a"), F.col(f"b.{key}") == F.col(f"a.{key}"), "full_outer")
    same = F.col("b.digest").eqNullSafe(F.col("a.digest"))
    return both.filter(~same).select(F.coalesce(f"b.{key}", f"a.{key}").alias(key))
