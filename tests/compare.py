"""Runs queries and their SQL side by side: python tests/compare.py [sf] [name ...]"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def sql_result(con, sql):
    columns = {r[0]: str(r[1]) for r in con.execute(f"describe {sql}").fetchall()}
    names = sorted(columns)
    rows = con.execute(sql).fetchall()
    at = [list(columns).index(n) for n in names]
    return names, [columns[n] for n in names], [tuple(r[i] for i in at) for r in rows]


def spark_result(df):
    names = sorted(df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    return names, [SPARK_TYPES.get(kinds[n], kinds[n]) for n in names], rows


def sort_key(row):
    return tuple((v is not None, str(v)) for v in row)


def difference(got, want):
    """None if equal, else a short text."""
    if got[0] != want[0]:
        return f"columns {set(got[0]) ^ set(want[0])}"
    if got[1] != want[1]:
        return "types " + str([(n, a, b) for n, a, b in zip(got[0], got[1], want[1]) if a != b])
    if len(got[2]) != len(want[2]):
        return f"rows {len(got[2])} != {len(want[2])}"
    for a, b in zip(sorted(got[2], key=sort_key), sorted(want[2], key=sort_key)):
        for n, x, y in zip(got[0], a, b):
            if x != y and not (
                isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-12)
            ):
                return f"{n}: {x!r} != {y!r} in {a} / {b}"[:600]
    return None


def main():
    from __spark_entry__ import oracle_sql, queries
    from tidemill.session import build_session

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{scale}"
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            got = spark_result(run(spark, folder))
            took = time.time() - start
            text = "rows only"
            if name in oracles:
                text = difference(got, sql_result(con, oracles[name]))
        except Exception as error:
            took, text = time.time() - start, f"ERROR {str(error)[:700]}"
        bad = text not in (None, "rows only")
        failed += bad
        rows = len(got[2]) if not str(text).startswith("ERROR") else "-"
        print(f"{'FAIL' if bad else 'ok  '} {name:26s} {took:6.2f}s rows={rows} {text or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
