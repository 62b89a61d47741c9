"""The table store on a catalog that replaces and merges tables itself.

For a Spark catalog with Iceberg tables.  Same methods as ``TableStore``; the
catalog keeps versions and makes each change atomic, so there is no commit log.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from siltworks.operators.cleanse import good_rows, quarantined_rows
from siltworks.operators.dedupe import require_unique
from siltworks.operators.history import VALID_TO, VERSION_ID, history_changes, merge_history
from siltworks.operators.quality import UNIQUE, Check, counters, numbered
from siltworks.operators.upsert import on_keys


@dataclass(frozen=True)
class Written:
    table: str
    rows: int | None
    # Failing rows of each check that the write has counted.
    checks: dict[str, int] | None = None


class CatalogStore:
    def __init__(
        self, spark: SparkSession, catalog: str, databases: dict[str, str],
        location: str | None = None,
    ):
        """``location`` is the folder tables are placed under; the catalog decides if None."""
        self.spark = spark
        self.catalog = catalog
        self.databases = databases
        self.location = location and location.rstrip("/")
        for database in databases.values():
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {catalog}.{database}")

    def name(self, layer: str, table: str) -> str:
        return f"{self.catalog}.{self.databases[layer]}.{table}"

    # -- reading ---------------------------------------------------------

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str, version: int | None = None) -> DataFrame:
        """The table, or an earlier snapshot of it."""
        if version is None:
            return self.spark.table(self.name(layer, table))
        return self.spark.read.option("snapshot-id", version).table(self.name(layer, table))

    def versions(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(f"{self.name(layer, table)}.snapshots")

    def _newest(self, layer: str, table: str):
        """The newest snapshot, if there is one: from the catalog's own records, without a scan."""
        if not self.exists(layer, table):
            return None
        snapshots = self.versions(layer, table).select("snapshot_id", "summary", "committed_at")
        return snapshots.orderBy(F.desc("committed_at")).first()

    # -- what the catalog tells --------------------------------------------

    def version_of(self, layer: str, table: str) -> int | None:
        newest = self._newest(layer, table)
        return newest and newest["snapshot_id"]

    def rows_of(self, layer: str, table: str) -> int | None:
        newest = self._newest(layer, table)
        total = newest and newest["summary"].get("total-records")
        return None if total is None else int(total)

    def counted(self, layer: str, table: str) -> dict[str, int] | None:
        """Not kept in the catalog: checks on stored tables are counted by a scan."""

    def inputs_of(self, layer: str, table: str) -> dict[str, int] | None:
        """Not kept in the catalog: the fact is computed from all orders, and merged."""

    # -- writing ---------------------------------------------------------

    def replace(
        self, layer: str, table: str, df: DataFrame, batch_id: str, run_date: str,
        allow_empty: bool = True, checks: Sequence[Check] = (), unique: Iterable[str] = (),
        cluster: tuple[str, int] | None = None,
    ) -> Written:
        """A new version; what fails ``checks`` is counted by the write.

        Whether a landed extract is empty shows in its first rows.  ``cluster`` (column, number)
        partitions the table into that many buckets.
        """
        if not allow_empty and df.isEmpty():
            raise ValueError(f"{layer}.{table}: no rows")
        unique = set(unique)
        rows = numbered(df, [c.column for c in checks if c.kind == UNIQUE and c.column not in unique])
        seen, failing = Observation(), counters(checks, unique)
        named = [c.alias(f"n{k}") for k, c in enumerate(failing.values())]
        writer = (
            rows.observe(seen, F.count(F.lit(1)).alias("rows"), *named)
            .select(*df.columns)
            .writeTo(self.name(layer, table))
            .using("iceberg")
            # Properties that the table format defines.
            .tableProperty("format-version", "2")
            .tableProperty("write.parquet.compression-codec", "snappy")
        )
        if cluster is not None:
            column, number = cluster
            writer = writer.partitionedBy(F.partitioning.bucket(number, column))
        if self.location is not None:
            writer = writer.tableProperty("location", f"{self.location}/{layer}/{table}")
        writer.createOrReplace()
        found = seen.get
        counted = {name: found.get(f"n{k}", 0) for k, name in enumerate(failing)}
        return Written(table, found.get("rows"), counted or None)

    def replace_split(
        self, layer: str, table: str, tagged: DataFrame, batch_id: str, run_date: str,
        checks: Sequence[Check] = (), unique: Iterable[str] = (),
        cluster: tuple[str, int] | None = None,
    ) -> tuple[Written, Written]:
        """Two tables from one evaluation, kept in the shared checkpoint folder."""
        once = tagged.checkpoint()
        how = {"checks": checks, "unique": unique, "cluster": cluster}
        return (
            self.replace(layer, table, good_rows(once), batch_id, run_date, **how),
            self.replace(layer, f"quarantine_{table}", quarantined_rows(once), batch_id, run_date),
        )

    def upsert(
        self, layer: str, table: str, source: DataFrame, keys: Sequence[str],
        batch_id: str, run_date: str, buckets: int | None = None, checks: Sequence[Check] = (),
        inputs: Mapping[str, int] | None = None,
    ) -> Written:
        """The catalog's own merge; it refuses a target row matched twice.

        It tells nothing about failing ``checks``, which are counted by a scan then, unless the first
        load creates the table.
        """
        if not self.exists(layer, table):
            cluster = (keys[0], buckets) if buckets else None
            rows = require_unique(source, keys)
            return self.replace(layer, table, rows, batch_id, run_date, True, checks, keys, cluster)
        name = self.name(layer, table)
        self._add_columns(name, source)
        self._merge(source, name, keys, updated=source.columns)
        return Written(table, self.rows_of(layer, table))

    def change(
        self, layer: str, table: str, build: Callable[[DataFrame | None], DataFrame],
        batch_id: str, run_date: str,
    ) -> Written:
        """Replace the table by what ``build`` makes of its rows (None without a table).

        The catalog refuses it if another writer was faster since the rows were read.
        """
        base = self.version_of(layer, table)
        if base is None:
            return self.replace(layer, table, build(None), batch_id, run_date)
        rows = build(self.read(layer, table, base))
        self._add_columns(self.name(layer, table), rows)
        seen = Observation()
        (
            rows.observe(seen, F.count(F.lit(1)).alias("rows"))
            .writeTo(self.name(layer, table))
            # Write options that the table format defines.
            .option("isolation-level", "serializable")
            .option("validate-from-snapshot-id", str(base))
            .overwrite(F.lit(True))
        )
        return Written(table, seen.get.get("rows"))

    def _add_columns(self, name: str, source: DataFrame) -> None:
        known = self.spark.table(name).columns
        added = [f"`{c}` {t}" for c, t in source.dtypes if c not in known]
        if added:
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")

    def keep_history(
        self, layer: str, table: str, source: DataFrame, key: str, check: Sequence[str],
        batch_id: str, run_date: str, as_of: datetime,
    ) -> Written:
        """Only ended and new versions are merged; the rest of the history stays as it is."""
        if not self.exists(layer, table):
            opened = merge_history(None, source, key, check, as_of)
            return self.replace(layer, table, opened, batch_id, run_date)
        name = self.name(layer, table)
        self._add_columns(name, source)
        changes = history_changes(self.spark.table(name), source, key, check, as_of)
        self._merge(changes, name, [VERSION_ID], updated=[VALID_TO])
        return Written(table, self.rows_of(layer, table))

    def _merge(
        self, source: DataFrame, name: str, keys: Sequence[str], updated: Sequence[str]
    ) -> None:
        (
            source.alias("s")
            .mergeInto(name, on_keys(name, "s", keys))
            .whenMatched().update({c: F.col(f"s.{c}") for c in updated})
            .whenNotMatched().insert({c: F.col(f"s.{c}") for c in source.columns})
            .merge()
        )

    def compact(self, layer: str, table: str) -> None:
        self._call("rewrite_data_files", layer, table, "strategy => 'binpack'")

    def expire(self, layer: str, tables: Sequence[str], keep: int = 5) -> None:
        for table in tables:
            self._call("expire_snapshots", layer, table, f"retain_last => {keep}")
            self._call("remove_orphan_files", layer, table)

    def rollback(self, layer: str, table: str, version: int) -> None:
        self._call("rollback_to_snapshot", layer, table, f"snapshot_id => {version}")

    def publish_projection(
        self, layer: str, view: str, from_layer: str, table: str, columns: Sequence[str]
    ) -> None:
        """A view in the catalog that keeps some columns of a table."""
        kept = ", ".join(f"`{c}`" for c in columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(layer, view)} AS "
            f"SELECT {kept} FROM {self.name(from_layer, table)}"
        )

    def _call(self, procedure: str, layer: str, table: str, *arguments: str) -> None:
        given = ", ".join([f"table => '{self.databases[layer]}.{table}'", *arguments])
        self.spark.sql(f"CALL {self.catalog}.system.{procedure}({given})")
