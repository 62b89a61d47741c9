"""Session settings that the tables rely on or run better with."""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Times without a zone in the extracts are UTC; day differences are 24 hours.
    "spark.sql.session.timeZone": "UTC",
    # Size shuffles and split uneven partitions at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets a write of good and quarantined rows keep both files open instead of
    # sorting every partition by outcome first.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # Stored steps go when nothing refers to them any more; read when a context starts.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# What a task of a sort reads at most: landed text takes some forty times its Parquet bytes in memory.
SPLIT_BYTES = 16 << 20


def limit_tasks(spark: SparkSession) -> None:
    """Settings of a running session under which the memory of a task does not grow with the tables.

    Files are cut into splits of at most ``SPLIT_BYTES``, and split and clustered writes keep their
    few files open instead of sorting once more.  Lower limits that are set stay.
    """
    split, writers = "spark.sql.files.maxPartitionBytes", "spark.sql.maxConcurrentOutputFileWriters"
    sizes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
    if sizes.byteStringAsBytes(spark.conf.get(split)) > SPLIT_BYTES:
        spark.conf.set(split, str(SPLIT_BYTES))
    if int(spark.conf.get(writers)) < int(SETTINGS[writers]):
        spark.conf.set(writers, SETTINGS[writers])


_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_inside: Counter[str] = Counter()
_before: dict[str, str | None] = {}
_lock = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries begun meanwhile remove their shuffle files when they end.

    Otherwise these stay until the driver happens to collect its garbage, so that those of many
    writes add up.  The setting is put back when the last of the threads inside leaves: Spark
    computes a shuffle anew if one frame is executed twice under it, which callers may do.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        if not _inside[session]:
            _before[session] = spark.conf.get(_SHUFFLES_GO, None)
            spark.conf.set(_SHUFFLES_GO, "true")
        _inside[session] += 1
    try:
        yield
    finally:
        with _lock:
            _inside[session] -= 1
            if not _inside[session]:
                del _inside[session]
                before = _before.pop(session)
                if before is None:
                    spark.conf.unset(_SHUFFLES_GO)
                else:
                    spark.conf.set(_SHUFFLES_GO, before)


def local_session(
    name: str, cores: int | str = 8, memory: str = "8g", extra: dict[str, str] | None = None
) -> SparkSession:
    """A session on one machine, for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
