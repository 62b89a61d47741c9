"""Lines that many documents share, in DataFrame functions only.

Lines are exploded with their position, normalised and hashed (128 bits); documents are counted per
hash; the positions to drop go back to their document, where the other lines are joined again.

The text crosses the network once, for that last join. The count is of (hash, document) pairs, which
Spark aggregates before and after a shuffle by both, so a line that a third of all documents hold is
spread by document. The repeated hashes are stored, which lets adaptive execution split the join of
lines with them: its right side has one row per hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import ascii_lower, opened, stored, whole

#: Fixed value: what is stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def repeated_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(k1, k2, first): hashes that at least `min_docs` documents hold, and the smallest of these.

    Rows without an id count as one document, after all others (`first` is null only if there is no
    other).
    """
    return (
        lines.groupBy("k1", "k2")
        .agg(
            F.count_distinct("id").alias("ids"),
            F.min("id").alias("first"),
            F.max(F.col("id").isNull().cast("int")).alias("without"),
        )
        .where(F.col("ids") + F.col("without") >= min_docs)
        .select("k1", "k2", "first")
    )


def dedup_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 2,
    min_chars: int = 10,
    out: str = "lines",
) -> DataFrame:
    """All columns of `docs` and a struct `out` of (n_lines, n_dropped, kept).

    A line whose key has `min_chars` code points or more and is found in `min_docs` documents stays
    only in the document with the smallest id. `kept` is the text of the other lines, joined by a
    line feed. Null or empty text is one empty line. Rows with the same id are one document, and
    rows without an id are one, after all others; such rows keep their own lines among themselves.
    An input column named as `out` is replaced. No row is lost or added.
    """
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    rows = whole(docs).select(
        "row", F.col("row")[id_col].alias("id"), F.xxhash64(text).alias("version"), text.alias("text")
    )
    lines = (
        rows.select("id", "version", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .select("id", "version", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select(
            "id",
            "version",
            "pos",
            F.xxhash64("key").alias("k1"),
            F.xxhash64(F.lit(1), "key").alias("k2"),
        )
    )
    dropped = (
        lines.join(stored(repeated_lines(lines, min_docs)), ["k1", "k2"])
        .where(~F.col("id").eqNullSafe(F.col("first")))
        .groupBy(F.col("id").alias("drop_id"), F.col("version").alias("drop_version"))
        .agg(F.collect_set("pos").alias("drop"))
    )
    marked = rows.join(
        dropped,
        F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("version") == F.col("drop_version")),
        "left",
    ).select("row", "drop", F.split("text", "\n").alias("all"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.col("drop"))
    kept = F.when(F.col("drop").isNull(), F.array_join("all", "\n")).otherwise(
        F.array_join(F.transform(stays, lambda i: F.get("all", i)), "\n")
    )
    result = F.struct(
        F.size("all").cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )
    return opened(marked, docs.columns, **{out: result})
