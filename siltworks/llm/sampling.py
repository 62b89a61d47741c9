"""Bounded samples of labelled rows, for models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.common import small, stored


def _shares(asked: dict, total: int) -> dict:
    """`total` dealt out: to each what it asks for, or an equal part of what smaller ones leave."""
    out: dict = {}
    for k, name in enumerate(sorted(asked, key=lambda name: (asked[name], str(name)))):
        out[name] = min(asked[name], (total - sum(out.values())) // (len(asked) - k))
    return out


def bounded(
    docs: DataFrame,
    marks: DataFrame | None,
    *,
    by: str,
    per_group: int,
    max_bytes: int,
    max_rows: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    carried: tuple[str, ...] = (),
) -> list:
    """At most `per_group` rows for each value of `by`, and `max_bytes` of text in all.

    With `max_rows`, values have an equal part of that many rows at most, and one at least.

    `by` is a column of `docs`, or of `marks` (id, by), which has one row per id. Rows are taken in
    the order of a hash of id and text, so the sample is the same on every run; equal texts count
    once. The choice is made on ids and sizes, so text is neither shuffled nor collected beyond it.
    Rows are (text, by, *carried).

    Each value has an equal share of `max_bytes`, and more where others leave some. Texts beyond an
    equal share are passed over, also in the ranks, and texts that no longer fit are passed over too.
    A value that has longer texts only gives the beginning of its shortest.
    """
    there = docs.where(F.col(text_col).isNotNull())
    sizes = there.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.octet_length(text_col).alias("bytes"),
        *([] if marks else [F.col(by).alias("by")]),
    )
    if marks:
        sizes = sizes.join(marks.select(F.col("id"), F.col(by).alias("by")), "id")
    texts = stored(
        sizes.where(F.col("by").isNotNull())
        .groupBy("by", "text_hash")
        .agg(F.min(F.struct(F.xxhash64("id", "text_hash").alias("order"), "id", "bytes")).alias("first"))
    )
    groups = max(1, texts.select("by").distinct().count())
    share = max_bytes // groups
    if max_rows is not None:
        per_group = max(1, min(per_group, max_rows // groups))
    size = F.col("first.bytes")
    fitting = small(
        stored(texts.groupBy(F.col("by").alias("of")).agg(F.count_if(size <= share).alias("n"), F.min(size).alias("least")))
    )
    # Ranks are needed among the smallest hashes only: of each value, four times the rows asked for.
    place = F.col("first.order") / F.lit(2.0**64) + 0.5
    chosen = (
        texts.join(fitting, F.col("by") == F.col("of"))
        .where((size <= share) | ((F.col("n") == 0) & (size == F.col("least"))))
        .where(place * F.col("n") < 4 * per_group + 100)
        .withColumn("nth", F.row_number().over(Window.partitionBy("by").orderBy("first.order")))
        .where(F.col("nth") <= per_group)
        .select("by", "text_hash", "nth", "first.order", "first.id", F.least(size, F.lit(share)).alias("bytes"))
        .orderBy("nth", "order")
        .collect()
    )
    asked: dict = {}
    for row in chosen:
        asked[row["by"]] = asked.get(row["by"], 0) + row["bytes"]
    left, wanted = _shares(asked, max_bytes), []
    for row in chosen:
        if row["bytes"] <= left[row["by"]]:
            left[row["by"]] -= row["bytes"]
            wanted.append((row["id"], row["text_hash"], row["order"], row["by"]))
    if not wanted:
        return []
    kinds = dict(sizes.dtypes) | ({"by": dict(marks.dtypes)[by]} if marks else {})
    schema = f"want_id {kinds['id']}, want_hash long, want_order long, want_by {kinds['by']}"
    picked = F.broadcast(docs.sparkSession.createDataFrame(wanted, schema))
    same = F.col(id_col).eqNullSafe(F.col("want_id")) & (F.xxhash64(text_col) == F.col("want_hash"))
    if not marks:
        same = same & (F.col(by) == F.col("want_by"))
    text = F.when(F.octet_length(text_col) > share, F.left(F.col(text_col), F.lit(share // 4))).otherwise(F.col(text_col))
    found = there.join(picked, same).select("want_order", text, "want_by", *carried).collect()
    once = {(row["want_order"], row["want_by"]): row for row in found}
    return [tuple(once[key])[1:] for key in sorted(once)]
