"""Data checks as rows: one result per check, counted on the executors."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

NOT_NULL = "not_null"
UNIQUE = "unique"
ACCEPTED = "accepted_values"
EXPRESSION = "expression_is_true"


@dataclass(frozen=True)
class Check:
    column: str
    kind: str
    allowed: tuple[str, ...] = ()
    expression: str = ""
    severity: str = "error"

    @property
    def label(self) -> str:
        return f"{self.kind}({self.expression})" if self.expression else self.kind

    @property
    def name(self) -> str:
        return f"{self.column} {self.label}"

    def fails(self) -> Column:
        """Condition for a failing row; NULL passes all but ``not_null``."""
        c = F.col(self.column)
        if self.kind == NOT_NULL:
            return c.isNull()
        if self.kind == ACCEPTED:
            return ~c.isin(*self.allowed)
        return ~F.expr(f"`{self.column}` {self.expression}")


# Prefix of columns that number the rows of a value.
_NTH = "_nth_with_equal_"


class CheckFailed(RuntimeError):
    pass


def _result(model: str, check: Check, failures: Column) -> Column:
    failures = F.coalesce(failures, F.lit(0)).cast("bigint")
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.label).alias("test"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
        F.when(failures == 0, F.lit("pass")).otherwise(F.lit(check.severity)).alias("status"),
    )


def evaluate(model: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Results of all checks on one model.

    Row checks share one scan.  A uniqueness check groups by its column, and the
    row checks ride along as partial counts, so a model with one unique column
    is still read once.
    """
    row_checks = [c for c in checks if c.kind != UNIQUE]
    unique = [c for c in checks if c.kind == UNIQUE]
    counted = [F.count_if(c.fails()).alias(f"f{i}") for i, c in enumerate(row_checks)]

    def as_rows(agg: DataFrame, pairs: Iterable[tuple[Check, Column]]) -> DataFrame:
        return agg.select(F.inline(F.array(*[_result(model, c, n) for c, n in pairs])))

    if not unique:
        found = df.agg(*counted)
        return as_rows(found, [(c, F.col(f"f{i}")) for i, c in enumerate(row_checks)])

    outputs = []
    for position, check in enumerate(unique):
        along = list(enumerate(row_checks)) if position == 0 else []
        per_value = df.groupBy(F.col(check.column).alias("value")).agg(
            F.count(F.lit(1)).alias("n"), *[counted[i] for i, _ in along]
        )
        found = per_value.agg(
            F.count_if((F.col("n") > 1) & F.col("value").isNotNull()).alias("repeated"),
            *[F.sum(f"f{i}").alias(f"f{i}") for i, _ in along],
        )
        pairs = [(check, F.col("repeated")), *[(c, F.col(f"f{i}")) for i, c in along]]
        outputs.append(as_rows(found, pairs))
    return reduce(DataFrame.unionByName, outputs)


def numbered(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows with their number among those of an equal value, for each of ``columns``.

    Neither a shuffle nor a sort of its own where ``df`` comes out of a join on the column.
    """
    return df.withColumns(
        {f"{_NTH}{c}": F.row_number().over(Window.partitionBy(c).orderBy(c)) for c in columns}
    )


def counters(
    checks: Iterable[Check], unique: Iterable[str] = (), within: Column | None = None
) -> dict[str, Column]:
    """Aggregates that count what fails, by name of the check, for a write to observe.

    Columns in ``unique`` cannot have repeated values; others need ``numbered`` rows.  ``within``
    is a condition for the rows that count.
    """
    out = {}
    for check in checks:
        failing = check.fails() if check.kind != UNIQUE else F.lit(False)
        if check.kind == UNIQUE and check.column not in unique:
            failing = (F.col(f"{_NTH}{check.column}") == 2) & F.col(check.column).isNotNull()
        out[check.name] = F.count_if(failing if within is None else failing & within)
    return out


def counted_results(
    spark: SparkSession, models: Mapping[str, tuple[Sequence[Check], Mapping[str, int]]]
) -> DataFrame:
    """Results of checks from the numbers of failing rows that writes have counted."""
    rows = [
        (model, check.column, check.label, check.severity, failures[check.name])
        for model, (checks, failures) in models.items()
        for check in checks
    ]
    schema = "model string, column_name string, test string, severity string, failures bigint"
    status = F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.col("severity"))
    return spark.createDataFrame(rows, schema).withColumn("status", status)


def require_passing(results: DataFrame) -> None:
    """Raise if any check of error severity failed; warnings only stay in the results."""
    failed = results.filter(F.col("status") == "error").collect()
    if failed:
        names = ", ".join(f"{r.model}.{r.column_name} {r.test}: {r.failures}" for r in failed)
        raise CheckFailed(names)


@dataclass(frozen=True)
class Freshness:
    warn_hours: int
    error_hours: int


def freshness(
    tables: Mapping[str, DataFrame],
    limits: Mapping[str, Freshness],
    as_of: datetime | Column,
    loaded_at: str = "_silver_timestamp",
) -> DataFrame:
    """Age of the newest row per table against its limits; no rows is an error."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    results = []
    for name, df in tables.items():
        limit = limits[name]
        newest = df.agg(F.max(loaded_at).cast("timestamp").alias("max_loaded_at"))
        age = F.unix_micros(now) - F.unix_micros("max_loaded_at")
        hour = 3_600_000_000
        results.append(
            newest.select(
                F.lit(name).alias("source"),
                "max_loaded_at",
                F.when(age.isNull() | (age > limit.error_hours * hour), F.lit("error"))
                .when(age > limit.warn_hours * hour, F.lit("warn"))
                .otherwise(F.lit("pass"))
                .alias("status"),
            )
        )
    return reduce(DataFrame.unionByName, results)
