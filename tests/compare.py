"""Runs registered queries and their SQL side by side and compares the rows exactly."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Spark type name to DuckDB type name.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def differences(df, connection, sql: str) -> list[str]:
    """Reasons why the frame and the SQL disagree; none if they agree."""
    names = sorted(df.columns)
    cursor = connection.execute(f"SELECT * FROM ({sql}) AS q")
    found = {d[0]: str(d[1]) for d in cursor.description}
    expected_rows = cursor.fetchall()
    order = [list(found).index(n) for n in names] if sorted(found) == names else None
    if order is None:
        return [f"columns {names} against {sorted(found)}"]
    problems = [
        f"type of {f.name}: {f.dataType.simpleString()} against {found[f.name]}"
        for f in df.schema.fields
        if TYPES.get(f.dataType.simpleString()) != found[f.name]
    ]
    rows = [tuple(canonical(v) for v in r) for r in df.select(*names).collect()]
    expected = [tuple(canonical(r[i]) for i in order) for r in expected_rows]
    if Counter(rows) != Counter(expected):
        ours, theirs = Counter(rows) - Counter(expected), Counter(expected) - Counter(rows)
        problems.append(f"{len(rows)} rows against {len(expected)}; {list(ours)[:3]} against {list(theirs)[:3]}")
    return problems


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = local_session(8)
    connection = duck(sf_dir)
    for name, run in queries().items():
        if name not in oracle_sql() or wanted and name not in wanted:
            continue
        began = time.time()
        try:
            df = run(spark, sf_dir)
            problems = differences(df, connection, oracle_sql()[name])
            text = "ok" if not problems else " | ".join(problems)[:1200]
        except Exception as error:  # report and go on with the next query
            text = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:24s} {time.time() - began:6.2f}s {text}", flush=True)
