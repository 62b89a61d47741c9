"""Tables as immutable Parquet folders, one per version, plus a commit record.

A plain Spark catalog can neither replace a table atomically nor overwrite one
that is being read.  So every change writes new folders and then creates one
record in the table's commit log; readers follow the newest record.  A job that
dies before the record leaves the former version in place.  Earlier versions
stay readable until ``expire``, and going back to one appends a record that
points at it.

A version need not rewrite everything: its record lists the folders that hold
its rows, and those that a change does not touch are listed again.  Tables with
a key are dealt to folders by it, histories keep the folders of ended versions.

A change that was computed from a version which is no longer the newest is
computed again, so writers may interleave.  ``catalog_store.CatalogStore`` has
the same methods for catalogs whose tables can be replaced and merged into.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import replace as changed
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from siltworks.operators.cleanse import OUTCOME, good_columns, quarantine_columns
from siltworks.operators.dedupe import require_unique
from siltworks.operators.history import VALID_FROM, VALID_TO, merge_history
from siltworks.operators.quality import UNIQUE, Check, counters, numbered
from siltworks.operators.upsert import upsert
from siltworks.session import shuffles_removed
from siltworks.sources.commit_log import Commit, CommitLog, Conflict
from siltworks.sources.shared_files import delete, modified, names_in
from siltworks.specs import GOOD, QUARANTINE

__all__ = ["Commit", "Conflict", "TableNotFound", "TableStore"]

# Length that compaction aims at for a file.
FILE_BYTES = 128 << 20
# Folders that the rows of a table with a key are dealt to, unless told otherwise.
BUCKETS = 16
# Rows that a task of an upsert writes, about.
TASK_ROWS = 250_000
# How often a change is computed anew because another writer was faster.
ATTEMPTS = 10
# Folder of ended versions within a written history; the rest is open.
_ENDED = "_ended"
_BUCKET = "_bucket"
_INSERTED = "_inserted"


class TableNotFound(LookupError):
    pass


class TableStore:
    def __init__(self, spark: SparkSession, root: str, databases: dict[str, str] | None = None):
        """``root`` is a folder every executor can reach.

        ``databases`` maps a layer to the catalog database in which its tables
        are published as views, e.g. ``{"silver": "silver_db"}``.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, self.root)
        self.databases = databases or {}
        for layer, database in self.databases.items():
            spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {database} "
                f"LOCATION '{self.root}/catalog/{layer}'"
            )

    # -- reading ---------------------------------------------------------

    def versions(self, layer: str, table: str) -> DataFrame:
        """The commit log of one table; without rows if there is none."""
        return self.log.frame(layer, table)

    def find(self, layer: str, table: str, version: int | None = None) -> Commit | None:
        """The newest commit, or the one with the given number, if there is one."""
        if version is not None:
            return self.log.read(layer, table, version)
        return next(self.log.newest_first(layer, table), None)

    def commit_of(self, layer: str, table: str, version: int | None = None) -> Commit:
        commit = self.find(layer, table, version)
        if commit is None:
            raise TableNotFound(f"{layer}.{table}" + (f" version {version}" if version else ""))
        return commit

    def exists(self, layer: str, table: str) -> bool:
        return self.find(layer, table) is not None

    def read(self, layer: str, table: str, version: int | None = None) -> DataFrame:
        return self._open(self.commit_of(layer, table, version))

    def _open(self, commit: Commit, parts: Sequence[str] | None = None) -> DataFrame:
        """Rows of a commit, or of some of its parts.

        Files clustered by a column are read through the catalog, where this session knows them
        there: joins and aggregates by that column then need no shuffle.
        """
        schema = T.StructType.fromJson(json.loads(commit.schema))
        parts = commit.parts if parts is None else list(parts)
        if parts == []:
            return self.spark.createDataFrame([], schema).select(*commit.columns)
        if commit.clustered and self.spark.catalog.tableExists(commit.clustered):
            return self.spark.table(commit.clustered).select(*commit.columns)
        folders = [f"{self.root}/{part}" for part in parts or [commit.path]]
        rows = self.spark.read.schema(schema).parquet(*folders)
        if commit.outcome is not None:
            rows = rows.filter(F.col(OUTCOME) == commit.outcome)
        return rows.select(*commit.columns)

    # -- what commits tell -------------------------------------------------

    def version_of(self, layer: str, table: str) -> int | None:
        commit = self.find(layer, table)
        return commit and commit.version

    def rows_of(self, layer: str, table: str) -> int | None:
        commit = self.find(layer, table)
        return commit and commit.rows

    def counted(self, layer: str, table: str) -> dict[str, int] | None:
        """Failing rows of the checks that the newest write has counted."""
        commit = self.find(layer, table)
        return commit and commit.checks

    def inputs_of(self, layer: str, table: str) -> dict[str, int] | None:
        """Versions of other tables that the newest version was computed from, if they are known."""
        commit = self.find(layer, table)
        return commit and commit.inputs

    def has_version(self, layer: str, table: str, version: int | None) -> bool:
        return version is not None and self.find(layer, table, version) is not None

    def same_rows(self, layer: str, table: str, one: int, other: int) -> bool:
        """Whether two versions are the same folders."""
        a, b = self.commit_of(layer, table, one), self.commit_of(layer, table, other)
        return (a.path, a.parts, a.columns) == (b.path, b.parts, b.columns)

    # -- writing ---------------------------------------------------------

    def replace(
        self, layer: str, table: str, df: DataFrame, batch_id: str, run_date: str,
        allow_empty: bool = True, checks: Sequence[Check] = (), unique: Iterable[str] = (),
        cluster: tuple[str, int] | None = None,
    ) -> Commit:
        """Write a new version and switch readers to it.

        Rows are counted by the write itself, as is what fails ``checks``; columns in ``unique``
        are known to have no repeated values.  With ``allow_empty=False`` an empty result is not
        committed.  ``cluster`` (column, number) deals the rows to that many files by the column,
        in layers that have a catalog database.
        """
        path, unique = self._new_path(layer, table), set(unique)
        rows = numbered(df, [c.column for c in checks if c.kind == UNIQUE and c.column not in unique])
        counts = {"rows": F.count(F.lit(1)), **counters(checks, unique)}
        if cluster and layer in self.databases:
            found, name = self._write_clustered(layer, table, rows, path, counts, df.columns, cluster)
        else:
            found, name = self._write(rows, path, counts, df.columns), None
        if not allow_empty and found["rows"] == 0:
            raise ValueError(f"{layer}.{table}: no rows")
        failures = {c.name: found[c.name] for c in checks} or None
        return self._until_committed(
            layer, table,
            lambda base: self._commit(
                layer, table, path, df, df.columns, found["rows"], batch_id, run_date, base,
                clustered=name, checks=failures,
            ),
        )

    def replace_split(
        self, layer: str, table: str, tagged: DataFrame, batch_id: str, run_date: str,
        checks: Sequence[Check] = (), unique: Iterable[str] = (),
        cluster: tuple[str, int] | None = None,
    ) -> tuple[Commit, Commit]:
        """Write both outcomes of a cleansed table in one pass; ``checks`` are of the good rows.

        The quarantine table is replaced as well when it has no rows, so rows
        quarantined by an earlier run do not linger.
        """
        path, columns = self._new_path(layer, table), tagged.columns
        counts = {o: F.count_if(F.col(OUTCOME) == o) for o in (GOOD, QUARANTINE)}
        counts |= counters(checks, set(unique), F.col(OUTCOME) == GOOD)
        if cluster and layer in self.databases:
            found, name = self._write_clustered(
                layer, table, tagged, path, counts, columns, cluster, (OUTCOME,)
            )
        else:
            found, name = self._write(tagged, path, counts, columns, (OUTCOME,)), None
        failures = {c.name: found[c.name] for c in checks} or None
        outputs = (
            (table, GOOD, good_columns(columns), {"clustered": name, "checks": failures}),
            (f"quarantine_{table}", QUARANTINE, quarantine_columns(columns), {}),
        )

        def record(name: str, outcome: str, kept: list[str], more: dict) -> Commit:
            return self._until_committed(
                layer, name,
                lambda base: self._commit(
                    layer, name, path, tagged, kept, found[outcome], batch_id, run_date, base,
                    outcome=outcome, **more,
                ),
            )

        good, quarantine = (record(*output) for output in outputs)
        return good, quarantine

    def upsert(
        self, layer: str, table: str, source: DataFrame, keys: Sequence[str],
        batch_id: str, run_date: str, buckets: int | None = None, checks: Sequence[Check] = (),
        inputs: Mapping[str, int] | None = None,
    ) -> Commit:
        """Merge ``source`` into the table by ``keys``; the first run creates it.

        Rows are dealt by a hash of their keys to ``buckets`` folders.  Only folders that a row of
        the source belongs to are read and written; the others are listed again in the new
        version, and a source without rows writes nothing.  The table is dealt anew when twice as
        many folders are wanted as it has.  ``source`` is read twice, the first time for its keys
        alone.  ``checks`` count what fails in the folders written.

        Both sides are shuffled once, by their keys and to a multiple of the number of folders: the
        hash that deals rows to folders is the one that Spark partitions by, so what a task joins
        belongs to one folder and is written as it comes.  That number follows the rows.
        """
        keys = list(keys)

        def bucket(rows: DataFrame, number: int) -> Column:
            return F.pmod(F.hash(*[rows[k] for k in keys]), F.lit(number))

        def attempt(base: Commit | None) -> Commit:
            dealt = base is not None and base.buckets is not None and base.bucket_keys == keys
            wanted = buckets or (base.buckets if dealt else BUCKETS)
            fits = dealt and wanted < 2 * base.buckets
            number = base.buckets if fits else wanted
            kept: list[str] = []
            typed = source.select(*keys)
            if fits:
                types = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(base.schema))}
                typed = source.select(*[F.col(k).cast(types[k]) for k in keys])
            with shuffles_removed(self.spark):
                found = typed.groupBy(bucket(typed, number)).count().collect()
            touched, expected = {r[0] for r in found}, sum(r[1] for r in found)
            if fits:
                kept = [p for p in base.parts if _bucket_of(p) not in touched]
                old = self._open(base, [p for p in base.parts if _bucket_of(p) in touched])
                expected += base.rows * (len(base.parts) - len(kept)) // max(1, len(base.parts))
            else:
                old = None if base is None else self._open(base)
                expected += base.rows if base else 0
            tasks = number * max(1, math.ceil(expected / (number * TASK_ROWS)))
            fresh_rows = source.repartition(tasks, *keys)
            if old is None:
                rows = require_unique(fresh_rows, keys).withColumn(_INSERTED, F.lit(True))
            else:
                rows = upsert(old.repartition(tasks, *keys), fresh_rows, keys, inserted=_INSERTED)
            columns = [c for c in rows.columns if c != _INSERTED]
            if fits and not touched:
                return self._commit(
                    layer, table, base.path, rows.drop(_INSERTED), columns, base.rows, batch_id,
                    run_date, base, parts=kept, buckets=number, bucket_keys=keys, mixed=base.mixed,
                    checks=base.checks, inputs=inputs and dict(inputs),
                )
            path = self._new_path(layer, table)
            placed = rows.withColumn(_BUCKET, bucket(rows, number))
            counts = {
                "rows": F.count(F.lit(1)), "inserted": F.count_if(_INSERTED),
                **counters(checks, set(keys)),
            }
            found = self._write(placed, path, counts, [*columns, _BUCKET], (_BUCKET,))
            parts = [f"{path}/{n}" for n in names_in(self.spark, f"{self.root}/{path}") if n.startswith(_BUCKET)]
            failures = {c.name: found[c.name] for c in checks}
            if kept and (base.checks is None or any(base.checks.values())):
                failures = {}  # what fails in the folders kept is not known by folder
            fresh = rows.select(*columns)
            return self._commit(
                layer, table, path, fresh, columns,
                base.rows + found["inserted"] if fits else found["rows"],
                batch_id, run_date, base, parts=kept + parts, buckets=number, bucket_keys=keys,
                mixed=bool(kept) and (bool(base.mixed) or base.schema != fresh.schema.json()),
                checks=failures or None, inputs=inputs and dict(inputs),
            )

        return self._until_committed(layer, table, attempt)

    def change(
        self, layer: str, table: str, build: Callable[[DataFrame | None], DataFrame],
        batch_id: str, run_date: str,
    ) -> Commit:
        """Replace the table by what ``build`` makes of its rows (None without a table).

        If another version is committed meanwhile, it is built again from that.
        """

        def attempt(base: Commit | None) -> Commit:
            rows = build(None if base is None else self._open(base))
            path = self._new_path(layer, table)
            counts = self._write(rows, path, {"rows": F.count(F.lit(1))}, rows.columns)
            return self._commit(
                layer, table, path, rows, rows.columns, counts["rows"], batch_id, run_date, base
            )

        return self._until_committed(layer, table, attempt)

    def keep_history(
        self, layer: str, table: str, source: DataFrame, key: str, check: Sequence[str],
        batch_id: str, run_date: str, as_of: datetime,
    ) -> Commit:
        """Next state of a history.

        Versions that ended before stay in the folders they are in, whose number of rows and newest
        time the record tells, so a run reads open versions only.  A folder less than twice as long
        as what came after it is merged with that, so their number grows with the logarithm of the
        rows.
        """

        def attempt(base: Commit | None) -> Commit:
            kept = _ended_parts(base)
            if base is not None and base.part_rows is not None:
                still_open = self._open(base, [p for p in base.parts if not _is_ended(p)])
                newest = F.timestamp_micros(F.lit(max(base.part_newest, default=None)).cast("bigint"))
                rows = merge_history(still_open, source, key, check, as_of, newest=newest)
            else:
                history = None if base is None else self._open(base)
                rows = merge_history(history, source, key, check, as_of)
            path = self._new_path(layer, table)
            ended = F.col(VALID_TO).isNotNull()
            newest_of = F.unix_micros(F.greatest(VALID_FROM, VALID_TO))
            counts = {
                "ended": F.count_if(ended), "open": F.count_if(~ended),
                "newest_ended": F.coalesce(F.max(F.when(ended, newest_of)), F.lit(0)),
                "newest_open": F.coalesce(F.max(F.when(~ended, newest_of)), F.lit(0)),
            }
            found = self._write(
                rows.withColumn(_ENDED, ended), path, counts, [*rows.columns, _ENDED], (_ENDED,)
            )
            schema = rows.schema
            mixed = bool(kept) and (bool(base.mixed) or base.schema != schema.json())
            if found["ended"]:
                kept = self._merged(
                    layer, table, schema,
                    [*kept, (f"{path}/{_ENDED}=true", found["ended"], found["newest_ended"])],
                )
            if found["open"]:
                kept = [*kept, (f"{path}/{_ENDED}=false", found["open"], found["newest_open"])]
            return self._commit(
                layer, table, path, rows, rows.columns, sum(n for _, n, _ in kept), batch_id,
                run_date, base, parts=[p for p, _, _ in kept], part_rows=[n for _, n, _ in kept],
                part_newest=[t for _, _, t in kept], mixed=mixed,
            )

        return self._until_committed(layer, table, attempt)

    def _merged(
        self, layer: str, table: str, schema: T.StructType, parts: list[tuple[str, int, int]]
    ) -> list[tuple[str, int, int]]:
        """Folders (path, rows, newest time), the last ones as one if they are alike in length."""
        parts, tail = parts[:-1], parts[-1:]
        while parts and parts[-1][1] < 2 * sum(n for _, n, _ in tail):
            tail = [parts[-1], *tail]
            parts = parts[:-1]
        if len(tail) == 1:
            return [*parts, *tail]
        rows = self._packed([p for p, _, _ in tail], schema, FILE_BYTES)
        path = f"{self._new_path(layer, table)}/{_ENDED}=true"
        found = self._write(rows, path, {"rows": F.count(F.lit(1))}, schema.names)
        return [*parts, (path, found["rows"], max(t for _, _, t in tail))]

    # -- maintenance -----------------------------------------------------

    def compact(self, layer: str, table: str, target: int = FILE_BYTES) -> Commit | None:
        """Pack the files of the current version if there are more than its bytes need, same rows.

        Of a table in several folders only those are rewritten that have too many files.  If
        another version is committed meanwhile, that one stays and nothing is done.
        """
        now = self.commit_of(layer, table)
        lengths = self._lengths(now)
        crowded = {p for p, (files, size) in lengths.items() if files > max(1, math.ceil(size / target))}
        if now.part_rows is not None:
            # All folders of ended versions count as one, and the open one.
            ended = [v for p, v in lengths.items() if _is_ended(p)]
            files, size = sum(f for f, _ in ended), sum(b for _, b in ended)
            crowded = {p for p in crowded if not _is_ended(p)}
            if files > max(1, math.ceil(size / target)):
                crowded |= {p for p in lengths if _is_ended(p)}
        if not crowded:
            return None
        fields: dict = {}
        schema = T.StructType.fromJson(json.loads(now.schema))
        path = self._new_path(layer, table)
        if now.buckets is not None:
            rows = self._open(now, sorted(crowded))
            dealt = F.pmod(F.hash(*[F.col(k) for k in now.bucket_keys]), F.lit(now.buckets))
            rows = rows.withColumn(_BUCKET, dealt).hint("rebalance", _BUCKET)
            self._write(rows, path, {"rows": F.count(F.lit(1))}, rows.columns, (_BUCKET,))
            new = [f"{path}/{n}" for n in names_in(self.spark, f"{self.root}/{path}") if n.startswith(_BUCKET)]
            fields = {"parts": [p for p in now.parts if p not in crowded] + new}
            fields |= {"buckets": now.buckets, "bucket_keys": now.bucket_keys}
            fields["mixed"] = now.mixed
        elif now.part_rows is not None:
            parts = list(zip(now.parts, now.part_rows, now.part_newest, strict=True))
            for is_ended in (True, False):
                own = [p for p in parts if p[0] in crowded and _is_ended(p[0]) == is_ended]
                if own:
                    folder = f"{path}/{_ENDED}={str(is_ended).lower()}"
                    packed = self._packed([p for p, _, _ in own], schema, target)
                    found = self._write(packed, folder, {"rows": F.count(F.lit(1))}, schema.names)
                    parts = [p for p in parts if p not in own]
                    parts.append((folder, found["rows"], max(t for _, _, t in own)))
            fields = {"parts": [p for p, _, _ in parts], "part_rows": [n for _, n, _ in parts]}
            fields |= {"part_newest": [t for _, _, t in parts], "mixed": now.mixed}
        else:
            size = sum(b for _, b in lengths.values())
            rows = self._packed(sorted(lengths), schema, target).select(*now.columns)
            most = max(1, math.ceil(1.2 * target * now.rows / max(1, size)))
            self._write(rows, path, {"rows": F.count(F.lit(1))}, now.columns, most_rows=most)
        try:
            return self._commit(
                layer, table, path, self.spark.createDataFrame([], schema), now.columns, now.rows,
                now.batch_id, now.run_date, now, checks=now.checks, inputs=now.inputs, **fields,
            )
        except Conflict:
            return None

    def _lengths(self, commit: Commit) -> dict[str, tuple[int, int]]:
        """Number of files and bytes in each folder of a commit; files are listed by Spark."""
        listed = self.spark.read.format("binaryFile").load(
            [f"{self.root}/{p}" for p in commit.parts or [commit.path]], pathGlobFilter="*.parquet"
        )
        if commit.outcome is not None:
            listed = listed.filter(F.col(OUTCOME) == commit.outcome)
        below = rf"/({commit.layer}/[^/]+/[0-9a-f]{{32}}(?:/[^/=]+=[^/]+)*)/[^/]+$"
        folder = F.regexp_extract("path", below, 1).alias("folder")
        found = listed.groupBy(folder).agg(F.count("length"), F.sum("length")).collect()
        return {r[0]: (r[1], r[2]) for r in found}

    def _packed(self, parts: Sequence[str], schema: T.StructType, target: int) -> DataFrame:
        """Rows of some folders, read so that each task gets whole files of up to ``target`` bytes.

        Spark's scan puts files into tasks by length, the longest first; longer ones are cut.  The
        limits are settings, so they are set in a session of its own.
        """
        session = self.spark.newSession()
        limits = {"maxPartitionBytes": target, "openCostInBytes": 0, "minPartitionNum": 1}
        for name, value in limits.items():
            session.conf.set(f"spark.sql.files.{name}", str(value))
        return session.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in parts])

    def rollback(self, layer: str, table: str, version: int) -> Commit:
        """Make an earlier version current again, without copying data."""
        old = self.commit_of(layer, table, version)

        def attempt(base: Commit | None) -> Commit:
            return self._record(
                changed(
                    old, version=base.version + 1, committed_at=_now(), restores=old.version
                )
            )

        return self._until_committed(layer, table, attempt)

    def expire(
        self, layer: str, keep: int = 5, younger_than: timedelta = timedelta(days=7),
        now: datetime | None = None,
    ) -> list[str]:
        """Remove versions of a layer's tables and the folders that none of the others needs.

        The newest ``keep`` versions of each table stay, as do all that are ``younger_than`` that.
        So do folders with younger files, which a writer may be about to commit; what a writer that
        died has left goes when it is older.  Returns the folders removed.  Files are listed by
        Spark; the driver sees folders.
        """
        limit = (now or datetime.now(timezone.utc)) - younger_than
        needed, gone = set(), []
        for table in self.log.tables(layer):
            for nth, commit in enumerate(self.log.newest_first(layer, table)):
                if nth < max(1, keep) or datetime.fromisoformat(commit.committed_at) > limit:
                    needed.update(_folder_of(p) for p in (commit.path, *(commit.parts or ())))
                else:
                    gone.append(commit)
        unused = [
            f"{layer}/{table}/{name}"
            for table in names_in(self.spark, f"{self.root}/{layer}")
            for name in names_in(self.spark, f"{self.root}/{layer}/{table}")
            if f"{layer}/{table}/{name}" not in needed
        ]
        # Records first, so that none is left that points at a folder removed.
        delete(self.spark, (self.log.name(c.layer, c.table, c.version) for c in gone))
        for name in {c.clustered for c in gone if c.clustered and _folder_of(c.path) not in needed}:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        old = self._last_written(unused, limit) if unused else []
        delete(self.spark, (f"{self.root}/{folder}" for folder in old))
        return old

    def _last_written(self, folders: list[str], limit: datetime) -> list[str]:
        """Those of the folders in which nothing was written after ``limit``."""
        listed = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load([f"{self.root}/{f}" for f in folders])
            .select("path", "modificationTime")
        )
        folder = F.regexp_extract("path", r"/([^/]+/[^/]+/[0-9a-f]{32})/", 1).alias("folder")
        newest = listed.groupBy(folder).agg(F.max("modificationTime").alias("at"))
        written = {r["folder"]: r["at"] for r in newest.select("folder", F.unix_micros("at").alias("at")).collect()}
        # A folder in which no file was finished has only its own time.
        for f in folders:
            written.setdefault(f, modified(self.spark, f"{self.root}/{f}"))
        return [f for f in folders if written[f] < limit.timestamp() * 1e6]

    # -- pieces ----------------------------------------------------------

    def _new_path(self, layer: str, table: str) -> str:
        """Below the root, so that a store stays readable after it is moved."""
        return f"{layer}/{table}/{uuid.uuid4().hex}"

    def _observed(self, rows: DataFrame, counts: Mapping[str, Column], columns: Sequence[str]):
        seen = Observation()
        named = [c.alias(f"n{k}") for k, c in enumerate(counts.values())]

        def counted(path: str) -> dict[str, int]:
            found = seen.get
            if any(found.get(f"n{k}") is None for k in range(len(named))):
                raise RuntimeError(f"{path}: the write did not report its counts")
            return {name: found[f"n{k}"] for k, name in enumerate(counts)}

        return rows.observe(seen, *named).select(*columns), counted

    def _write(
        self, rows: DataFrame, path: str, counts: Mapping[str, Column], columns: Sequence[str],
        partition_by: Sequence[str] = (), most_rows: int | None = None,
    ) -> dict[str, int]:
        observed, counted = self._observed(rows, counts, columns)
        writer = observed.write.option("compression", "snappy")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if most_rows:
            writer = writer.option("maxRecordsPerFile", most_rows)
        with shuffles_removed(rows.sparkSession):
            writer.parquet(f"{self.root}/{path}")
        return counted(path)

    def _write_clustered(
        self, layer: str, table: str, rows: DataFrame, path: str, counts: Mapping[str, Column],
        columns: Sequence[str], cluster: tuple[str, int], partition_by: Sequence[str] = (),
    ) -> tuple[dict[str, int], str | None]:
        """Counts of the write, and the catalog table that knows about the clusters.

        Of a split table that is one of the good rows; the quarantine is read as plain files.
        """
        column, number = cluster
        name = f"{self.databases[layer]}.`{table}__{path[-32:]}`"
        observed, counted = self._observed(rows.repartition(number, column), counts, columns)
        writer = observed.write.format("parquet").option("compression", "snappy")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with shuffles_removed(rows.sparkSession):
            writer.bucketBy(number, column).option("path", f"{self.root}/{path}").saveAsTable(name)
        found = counted(path)
        if partition_by:
            self.spark.sql(f"DROP TABLE {name}")
            if not found[GOOD]:
                return found, None
            kept = [f for f in rows.schema if f.name in columns and f.name not in partition_by]
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
            self.spark.sql(
                f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (`{column}`) "
                f"INTO {number} BUCKETS LOCATION '{self.root}/{path}/{OUTCOME}={GOOD}'"
            )
        return found, name

    def _until_committed(
        self, layer: str, table: str, attempt: Callable[[Commit | None], Commit]
    ) -> Commit:
        """Call ``attempt`` with the newest version until no other writer is faster."""
        for _ in range(ATTEMPTS):
            try:
                return attempt(self.find(layer, table))
            except Conflict as conflict:
                last = conflict
        raise last

    def _commit(
        self, layer: str, table: str, path: str, df: DataFrame, columns: Sequence[str],
        rows: int, batch_id: str, run_date: str, base: Commit | None, outcome: str | None = None,
        **fields,
    ) -> Commit:
        """Record a version computed from ``base``; a Conflict if that is no longer the newest."""
        return self._record(
            Commit(
                layer, table, base.version + 1 if base else 1, path, outcome, df.schema.json(),
                list(columns), rows, batch_id, run_date, _now(), **fields,
            )
        )

    def _record(self, commit: Commit) -> Commit:
        commit = self.log.append(commit)
        # Another writer may have published a later version before this one: the newest stays.
        shown = commit
        self._publish(shown)
        while (newest := self.find(commit.layer, commit.table)) and newest.version > shown.version:
            shown = newest
            self._publish(shown)
        return commit

    def _publish(self, commit: Commit) -> None:
        """Point the catalog view of this table at the committed folders."""
        database = self.databases.get(commit.layer)
        if database is None:
            return
        schema = T.StructType.fromJson(json.loads(commit.schema))
        kept = ", ".join(f"`{c}`" for c in commit.columns)
        if not commit.rows:
            # A folder without files has no schema to read.
            empty = (
                f"CAST(NULL AS {schema[c].dataType.simpleString()}) AS `{c}`"
                for c in commit.columns
            )
            body = f"SELECT {', '.join(empty)} WHERE false"
        elif commit.clustered and self.spark.catalog.tableExists(commit.clustered):
            body = f"SELECT {kept} FROM {commit.clustered}"
        else:
            parts = commit.parts or [commit.path]
            place = parts[0] if len(parts) == 1 else "{" + ",".join(parts) + "}"
            merging = " WITH (mergeSchema = 'true')" if commit.mixed else ""
            body = f"SELECT {kept} FROM parquet.`{self.root}/{place}`{merging}"
            if commit.outcome is not None:
                body += f" WHERE {OUTCOME} = '{commit.outcome}'"
        self.spark.sql(f"CREATE OR REPLACE VIEW {database}.`{commit.table}` AS {body}")

    def publish_projection(
        self, layer: str, view: str, from_layer: str, table: str, columns: Sequence[str]
    ) -> None:
        """A catalog view that keeps some columns of a published table."""
        if layer in self.databases and from_layer in self.databases:
            kept = ", ".join(f"`{c}`" for c in columns)
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {self.databases[layer]}.`{view}` AS "
                f"SELECT {kept} FROM {self.databases[from_layer]}.`{table}`"
            )

    def publish_all(self, layer: str, tables: Sequence[str]) -> None:
        """Recreate the catalog views in a session that does not have them."""
        for table in tables:
            commit = self.find(layer, table)
            if commit is not None:
                self._publish(commit)


def _bucket_of(part: str) -> int:
    return int(part.rpartition("=")[2])


def _is_ended(part: str) -> bool:
    return part.endswith(f"{_ENDED}=true")


def _ended_parts(commit: Commit | None) -> list[tuple[str, int, int]]:
    """(path, rows, newest time) of the folders of ended versions."""
    if commit is None or commit.part_rows is None:
        return []
    parts = zip(commit.parts, commit.part_rows, commit.part_newest, strict=True)
    return [p for p in parts if _is_ended(p[0])]


def _folder_of(path: str) -> str:
    """The folder that one write has made: layer, table and a name."""
    return "/".join(path.split("/")[:3])


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="microseconds")
