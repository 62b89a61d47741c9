"""A folder for written tables that all executors can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder under the cluster's checkpoint folder.

    Only a local session without that setting, as in tests, gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="siltworks-")
    return f"{base.rstrip('/')}/siltworks/{uuid.uuid4().hex}"
