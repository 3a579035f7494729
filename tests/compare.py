"""Run registered queries against their checking SQL in DuckDB and compare whole results.

    python tests/compare.py /root/testdata/sf0.01 [name ...]

With SHARE_INBOUND=1 the reports read one written inbound table, which is quicker.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


SPARK_KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def differences(spark, con, name, query, sql, sf_dir) -> list[str]:
    df = query(spark, sf_dir)
    actual = rows_of(df.columns, df.collect())
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]) for d in found.description}
    expected = rows_of(names, found.fetchall())
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    for column, kind in df.dtypes:
        other = kinds.get(column)
        if other and SPARK_KINDS.get(kind, kind) != other:
            problems.append(f"type of {column}: {kind} != {other}")
    if actual != expected:
        problems.append(
            f"rows {sum(actual.values())} vs {sum(expected.values())}; "
            f"only spark {list((actual - expected).items())[:2]}; "
            f"only sql {list((expected - actual).items())[:2]}"
        )
    if not expected:
        problems.append("empty result")
    return problems


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from quayside.registry import core
    from quayside.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    if os.environ.get("SHARE_INBOUND"):
        core.shared = {}
    sqls, bad = oracle_sql(), 0
    for name, query in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problems = differences(spark, con, name, query, sqls[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{name:10s} {'ok' if not problems else 'FAIL'} {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("    " + p[:900], flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(main())
