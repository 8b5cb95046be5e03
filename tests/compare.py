"""Run Spark queries next to their SQL twins: ``python -m tests.compare [sf_dir] [keys...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0  # -0.0 and 0.0 are one value
    if hasattr(value, "as_tuple"):
        return float(value)
    return value


def _bag(rows: list, columns: list[str]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL result; empty when they agree."""
    done = con.execute(sql)
    names = [d[0] for d in done.description]
    types = dict(zip(names, [str(d[1]) for d in done.description]))
    expected = done.fetchall()
    actual = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
        return problems
    wanted = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}
    for name, kind in df.dtypes:
        if wanted.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: {kind} / {types[name]}")
    a, b = _bag(actual, df.columns), _bag(expected, names)
    if a != b:
        extra, lost = list((a - b).items())[:3], list((b - a).items())[:3]
        problems.append(f"{len(actual)} rows / {len(expected)}; {sum((a - b).values())} only in Spark {extra}; only in SQL {lost}")
    return problems


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from freshet.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    queries, oracles = entry.queries(), entry.oracle_sql()
    keys = argv[1:] or list(queries)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for key in keys:
        began = time.time()
        try:
            df = queries[key](spark, sf_dir)
            problems = compare(df, con, oracles[key]) if key in oracles else []
            rows = ""
        except Exception as error:  # noqa: BLE001 - report and go on
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {key} {time.time() - began:.1f}s {' | '.join(problems)}", flush=True)
    print(f"{len(keys) - bad}/{len(keys)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
