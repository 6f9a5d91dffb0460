"""Compare registered queries with their SQL on DuckDB.

    python tests/oracle.py [folder] [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(arrow) -> list[tuple]:
    names = sorted(arrow.column_names)
    columns = [arrow.column(n).to_pylist() for n in names]
    return sorted(tuple(canonical(v) for v in row) for row in zip(*columns))


def schema_of(arrow) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in arrow.schema}


def compare(spark, con, run, sql: str, folder: str) -> str | None:
    """None when names, types, row count and values agree, else what differs."""
    ours = run(spark, folder).toArrow()
    theirs = con.sql(sql).to_arrow_table()
    if schema_of(ours) != schema_of(theirs):
        a, b = schema_of(ours), schema_of(theirs)
        diff = {k: (a.get(k), b.get(k)) for k in sorted(a.keys() | b.keys()) if a.get(k) != b.get(k)}
        return f"schema (spark, sql): {diff}"
    if ours.num_rows != theirs.num_rows:
        return f"rows: spark {ours.num_rows}, sql {theirs.num_rows}"
    if ours.num_rows == 0:
        return "no rows on either side"
    for a, b in zip(rows_of(ours), rows_of(theirs)):
        if a != b:
            return f"values: spark {a} sql {b} columns {sorted(ours.column_names)}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = build_session("oracle", "local[8]", **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, run, sql[name], folder)
            else:
                n = len(run(spark, folder).collect())
                problem = None if n else "no rows"
        except Exception as exc:  # report and go on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += problem is not None
        kind = "sql " if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
