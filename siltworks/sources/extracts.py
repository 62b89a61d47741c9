"""CSV extracts: path, read, contract, lineage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltworks.functions.measures import moment
from siltworks.specs import TableSpec


class ContractError(ValueError):
    """An extract does not have the columns or rows its table needs."""


def extract_path(root: str, source: str, run_date: str, table: str) -> str:
    """Exactly one run date and one table, never a wildcard.

    The path may be a single file or a folder of part files; in a folder each
    part is read by its own task.
    """
    return f"{root.rstrip('/')}/run_date={run_date}/{source}_{table}_dataset.csv"


def read_extract(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; quoted fields may span lines and double their quotes."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')


def missing_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    """Required columns that are absent; names compare exactly, extras are fine."""
    return [c for c in spec.contract if c not in df.columns]


def check_contract(df: DataFrame, spec: TableSpec) -> DataFrame:
    missing = missing_columns(df, spec)
    if missing:
        raise ContractError(f"{spec.name}: missing required columns {missing}")
    return df


def stamp_landing(
    df: DataFrame, batch_id: str, run_date: str, as_of: datetime | Column | None = None,
    file_column: str | None = None,
) -> DataFrame:
    """Lineage per row: when, from which file, in which run.

    The file is the one that Spark reads a row from, or what the reader has put
    into ``file_column``, which is dropped; never a column of the extract.
    """
    lineage = {
        "_ingestion_timestamp": moment(as_of),
        "_source_file": F.col(file_column) if file_column else F.input_file_name(),
        "_batch_id": F.lit(batch_id),
        "_run_date": F.lit(run_date),
    }
    business = [c for c in df.columns if c not in lineage and c != file_column]
    return df.select(*business, *[value.alias(name) for name, value in lineage.items()])
