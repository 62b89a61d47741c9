"""Run records: one row per pipeline and run date, the last write wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from siltworks.operators.dedupe import first_per_key
from siltworks.operators.upsert import upsert

# Column names that readers of the ledger expect.
KEYS = ("pipeline_name", "run_date")
SCHEMA = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in ("pipeline_name", "run_date", "status", "execution_arn", "started_at")
    ]
)


def last_per_run(records: DataFrame) -> DataFrame:
    """The latest record of each run, when a batch holds several."""
    newest = [F.col(c).desc_nulls_last() for c in ("started_at", "execution_arn", "status")]
    return first_per_key(records, KEYS, newest)


def record(ledger: DataFrame, records: DataFrame) -> DataFrame:
    """Put new run records into the ledger, replacing those of the same run."""
    return upsert(ledger, last_per_run(records), KEYS)
