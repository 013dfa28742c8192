"""Run registered queries in Spark and their SQL in DuckDB, and compare names, types and rows.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tollbook.session import build_session  # noqa: E402

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, list):
        return tuple(value)
    return value


def compare(spark, connection, folder: str, name: str) -> tuple[int, str]:
    """Row count, and what differs (nothing if equal)."""
    df = entry.queries()[name](spark, folder)
    columns = sorted(df.columns)
    rows = Counter(tuple(_plain(v) for v in row) for row in df.select(*columns).collect())
    count = sum(rows.values())
    if name not in entry.oracle_sql():
        return count, "" if count else "no rows"
    result = connection.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    types = dict(zip(names, (str(d[1]) for d in result.description)))
    order = [names.index(c) for c in sorted(names)]
    wanted = Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())
    problems = []
    if sorted(names) != columns:
        problems.append(f"columns {columns} against {sorted(names)}")
    else:
        spark_types = dict(df.dtypes)
        problems += [f"{c}: {spark_types[c]} against {types[c]}" for c in columns
                     if TYPES.get(spark_types[c], spark_types[c]) != types[c]]
    if rows != wanted:
        problems.append(f"{count} rows against {sum(wanted.values())}; only in Spark {list((rows - wanted).items())[:3]},"
                        f" only in SQL {list((wanted - rows).items())[:3]}")
    if not count:
        problems.append("no rows")
    return count, "; ".join(problems)


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session("compare", cores=8, shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name in names or entry.queries():
        start = time.time()
        try:
            count, problem = compare(spark, connection, folder, name)
        except Exception as error:  # noqa: BLE001
            count, problem = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        kind = "sql" if name in entry.oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name} {count} {kind} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} of {len(names or entry.queries())} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
