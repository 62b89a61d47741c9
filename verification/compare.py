"""Run the registered queries and their SQL side by side: python -m verification.compare DIR [names]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from siltworks.session import local_session
from verification.oracles import oracle_sql
from verification.queries import queries


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def spark_rows(df) -> Counter:
    columns = sorted(df.columns)
    return Counter(tuple(cell(v) for v in row) for row in df.select(*columns).collect())


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(cell(row[i]) for i in order) for row in result.fetchall())
    return sorted(names), rows


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None if equal, else what differs."""
    df = queries()[name](spark, sf_dir)
    names, expected = sql_rows(con, oracle_sql()[name])
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} against {names}"
    actual = spark_rows(df)
    if actual == expected:
        return None
    more, less = actual - expected, expected - actual
    return (
        f"rows {sum(actual.values())} against {sum(expected.values())}; only here "
        f"{sum(more.values())}: {list(more)[:2]}; only there {sum(less.values())}: {list(less)[:2]}"
    )


def main() -> int:
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session("compare"), connect(sf_dir)
    bad = 0
    for name in wanted or queries():
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        label = "ok " if problem is None else "BAD"
        print(f"{label} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
