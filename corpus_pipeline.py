"""From documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import decontamination, line_dedup, packing, simhash, toxicity
from siltworks.llm.common import drop_folder, opened, read, shared_folder, whole
from siltworks.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from labelled documents given to it."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that other documents hold too stay in the first one only; the text is what is left.

    Documents stay, also those that lose all their lines; `n_chars`, if there, follows the text.
    """
    marked = line_dedup.dedup_lines(whole(docs).select("row", "row.doc_id", "row.text"), out="lines")
    changed, kept = F.col("lines.n_dropped") > 0, F.col("lines.kept")
    added = {"text": F.when(changed, kept).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        added["n_chars"] = F.when(changed, F.char_length(kept).cast(kind)).otherwise(F.col("row.n_chars"))
    return opened(marked, docs.columns, **added).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints two bits apart or less, the one with the smallest id stays."""
    return simhash.one_of_each(docs, shingle=3, max_bits=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item, or all of a shorter one, go."""
    found = decontamination.find_passages(
        whole(docs).select("row", "row.text"), read(spark, sf_dir, "benchmark"), length=10
    )
    return opened(found.where("hits.n_hit = 0"), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents left, with their place in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path(), capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: A trained classifier and a tokenizer take part, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. Each writes Parquet that the next one reads, and that goes then.

    The result is read from the folder of the last stage, which stays.
    """
    docs, before = read(spark, sf_dir, "documents"), None
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            drop_folder(spark, f"{folder}/{before}")
        before = name
    return docs
