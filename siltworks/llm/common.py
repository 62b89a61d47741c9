"""What the operators share: stored steps, block counts, row structs, held-out rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for stored steps, in that of `spark.checkpoint.dir`.

    Where the setting is missing, which is right only on one machine, a folder of its own is used.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and (not context.master.startswith("local") or "cluster" in context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="llm-"))
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """Compute once, in the shared folder, and cut the lineage. A lost executor then costs no earlier step."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder that no table is read from any more, on any file system that Spark reaches."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """A stored `df`, sent to all tasks in joins if it has `rows` rows or fewer, else not."""
    return F.broadcast(df) if df.count() <= rows else df


def whole(df: DataFrame) -> DataFrame:
    """Each row as one struct `row`, so that no column name of the input can clash."""
    return df.select(F.struct("*").alias("row"))


def opened(df: DataFrame, columns: list[str], **added: Column) -> DataFrame:
    """The columns of `row` again and those in `added`; one of the same name is replaced."""
    new = {name.lower() for name in added}
    old = [F.col("row").getField(c).alias(c) for c in columns if c.lower() not in new]
    return df.select(*old, *(value.alias(name) for name, value in added.items()))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts: one aggregate row."""
    return docs.select(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def blocks(total: int, each: int) -> int:
    """How many blocks of about `each` hold `total`; at least one."""
    return max(1, -(-total // each))


def held_out(doc_id: Column) -> Column:
    """Rows no labels are learned from: crc32 of the id as text, modulo 4, is 2. No id: held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and no other letter."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )
