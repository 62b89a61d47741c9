"""Mixing sources to target weights with thresholds on a hash, in DataFrame functions only.

Every document has a place, a 60-bit hash of its id and text. A source gives all of its documents as
often as its target allows, and once more those whose place lies below a threshold. To find it, words
are summed by source and the first 8 bits of the place. The sums, in order, tell which bucket the
budget ends in, and only documents of that one bucket are summed by the next 8 bits, until a bucket
is one place. Budgets of one source are cut out of the same order, so a smaller one takes a part of
what a larger one takes.

Nothing is sorted but the sums of a source, 256 at a time. Documents never cross the network: they
are summed where they are, however many one source has, and the thresholds go to them. What is sent
to all tasks are boundary buckets and thresholds, while there are at most 100,000 of them; beyond
that, Spark joins by source. The driver sees two numbers a round when it reshares what sources cannot
take.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.common import opened, small, stored, whole

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a place, and of one round.
BITS, STEP = 60, 8


def words(text: Column) -> Column:
    """How many words the text has; 0 if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(doc_id: Column, text: Column) -> Column:
    """A number below 2**60, the same in every run. Equal ids with equal texts have the same one."""
    digest = F.md5(F.concat_ws("/", doc_id.cast("string"), F.md5(text.cast("binary"))).cast("binary"))
    return F.conv(F.left(digest, F.lit(BITS // 4)), 16, 10).cast("long")


def _with_weights(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Each source with its weight: sources by code point, null last, take the weights in turn.

    Sources are dealt to tasks by ranges, so that a source's rank is the number of those in earlier
    ranges and its place in its own.
    """
    dealt = stored(
        sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    )
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(F.col("part").alias("p")).count().select(
        "p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    ranked = dealt.withColumn("nth", F.row_number().over(within) - 1).join(
        F.broadcast(starts), F.col("part") == F.col("p")
    )
    turn = (F.col("base") + F.col("nth")) % len(weights)
    weight = F.get(F.array(*map(F.lit, weights)), turn.cast("int")).cast("long")
    return ranked.select("source", "source_size", weight.alias("weight"))


def targets(sizes: DataFrame, *, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    All words are shared among sources by weight. No target is more than `most` times its source's
    size; what is above is shared among the others in the same way, until no target is above. Sources
    without words have target 0.
    """
    known = stored(_with_weights(sizes, weights))
    known = known.withColumn("cap", most * F.col("source_size"))
    row = known.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    total, rest, weight = row["words"] or 0, row["words"] or 0, row["weight"] or 1
    while True:
        # Whole numbers of up to 38 digits, so that nothing is rounded where a share meets its cap.
        wide = [F.lit(x).cast("decimal(19,0)") for x in (rest, weight)]
        above = F.col("weight").cast("decimal(19,0)") * wide[0] > F.col("cap").cast("decimal(19,0)") * wide[1]
        row = known.agg(
            F.sum(F.when(above, F.col("cap"))).alias("full"), F.sum(F.when(~above, F.col("weight"))).alias("weight")
        ).first()
        new = total - (row["full"] or 0), row["weight"] or 1
        if new == (rest, weight):
            break
        rest, weight = new
    share = (F.col("weight") * rest).cast("double") / F.lit(weight).cast("double")
    target = F.when(above, F.col("cap").cast("double")).otherwise(share)
    return known.select("source", "source_size", "weight", target.alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, level, below) from (source, place, size) and (source, level, budget).

    Documents of a source with a place less than `below` have words as near to the budget as any
    such limit gets; of two limits equally near, the lower. Documents with one place are taken or
    left together. Budgets of 0 or less take nothing; budgets not below the source's size take
    everything and need not be asked.
    """
    sized = sized.where(F.col("size") > 0)
    spark, shift = sized.sparkSession, BITS
    open_ = stored(
        budgets.where(F.col("budget") > 0).select("source", "level", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
    )
    done = spark.createDataFrame([], f"source {dict(budgets.dtypes)['source']}, level int, below long")
    while open_.count():
        last, shift = shift, max(0, shift - STEP)
        asked = small(open_.select(F.col("source").alias("of"), F.col("prefix").alias("in")).distinct())
        inside = F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("place", last) == F.col("in"))
        sums = (
            sized.join(asked, inside)
            .groupBy("of", "in", F.shiftright("place", shift).alias("bucket"))
            .agg(F.sum("size").alias("words"), F.min("place").alias("least"), F.max("place").alias("largest"))
        )
        met = small(open_).join(sums, F.col("source").eqNullSafe(F.col("of")) & (F.col("prefix") == F.col("in")))
        ordered = Window.partitionBy("source", "level").orderBy("bucket")
        found = (
            met.withColumn("after", F.col("before") + F.sum("words").over(ordered))
            .where(F.col("after") >= F.col("budget"))
            .withColumn("nth", F.row_number().over(ordered))
            .where(F.col("nth") == 1)
        )
        found = stored(found.select("source", "level", "budget", F.col("bucket").alias("prefix"), (F.col("after") - F.col("words")).alias("before"), "after", "least", "largest"))
        one = F.col("least") == F.col("largest")
        taken = F.col("after") - F.col("budget") < F.col("budget") - F.col("before")
        below = F.when(taken, F.col("least") + 1).otherwise(F.col("least"))
        done = done.unionByName(found.where(one).select("source", "level", below.alias("below")))
        open_ = found.where(~one).select("source", "level", "budget", "prefix", "before")
    return done


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    out: str = "mix",
) -> DataFrame:
    """All columns of `docs` and a struct `out` of (size, source_size, target, copies, taken).

    `size` are the words of a text, `source_size` those of its source, `target` how many the mix
    should take from that source (see `targets`), `copies` how often it takes the document, from 0 to
    `most`, and `taken` = `copies` * `size`. Documents are taken whole, so a source misses its target
    by up to half of the document at the threshold.

    Null and empty texts have size 0; rows without a source are one source, the last. Rows with equal
    id and text are taken or left together; so are all rows without an id that have equal texts. An
    empty table stays empty. An input column named as `out` is replaced; no row is lost or added.
    """
    row = F.col("row")
    rows = whole(docs).select(
        "row",
        row[source_col].alias("source"),
        words(row[text_col]).alias("size"),
        place(row[id_col], row[text_col]).alias("place"),
    )
    sized = stored(rows.select("source", "place", "size"))
    wanted = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights=weights, most=most))
    size, target = F.col("source_size"), F.col("target")
    # Copies taken of all documents; what is then missing is a budget below the source's size.
    every = sum((F.when((size > 0) & (target >= k * size), 1).otherwise(0) for k in range(1, most + 1)), F.lit(0))
    wanted = wanted.select("*", every.alias("every")).withColumn("budget", target - F.col("every") * size)
    parts = thresholds(sized, wanted.select("source", F.lit(1).alias("level"), "budget"))
    limits = wanted.join(
        parts.select(F.col("source").alias("of"), "below"), F.col("source").eqNullSafe(F.col("of")), "left"
    ).select(F.col("source").alias("from"), "source_size", "target", "every", "below")
    met = rows.join(small(stored(limits)), F.col("source").eqNullSafe(F.col("from")), "left")
    copies = F.col("every") + F.when(F.col("place") < F.col("below"), 1).otherwise(0)
    result = F.struct(
        "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
    return opened(met, docs.columns, **{out: result})
