"""Run queries in both engines and compare all rows. Usage: python tests/compare.py DIR [NAME ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return tuple(plain(v) for v in value) if isinstance(value, (list, tuple)) else value


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


# Names of the same types in both engines.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "double": "DOUBLE"}


def rows_of_sql(con, sql: str) -> tuple[list[tuple[str, str]], Counter]:
    cursor = con.execute(sql)
    columns = [(d[0], str(d[1])) for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i][0])
    return sorted(columns), Counter(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())


def rows_of_df(df) -> tuple[list[tuple[str, str]], Counter]:
    columns = sorted((name, TYPES.get(kind, kind)) for name, kind in df.dtypes)
    return columns, Counter(tuple(plain(v) for v in row) for row in df.select(*[c[0] for c in columns]).collect())


def main() -> int:
    import __spark_entry__ as contract
    from itemsync.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, failures = connect(folder), 0
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        try:
            begin = time.time()
            columns, got = rows_of_df(query(spark, folder))
            middle = time.time()
            sql_columns, expected = rows_of_sql(con, contract.oracle_sql()[name])
            spent = f"{middle - begin:6.2f} {time.time() - middle:6.2f}"
            same = columns == sql_columns and got == expected
            print(f"{'ok  ' if same else 'DIFF'} {name:30s} {sum(got.values()):8d} {spent}", flush=True)
            if not same:
                failures += 1
                print("  columns", columns, sql_columns)
                print("  spark ", sum(got.values()), list((got - expected).items())[:2])
                print("  sql   ", sum(expected.values()), list((expected - got).items())[:2])
        except Exception as error:
            failures += 1
            print(f"FAIL {name}: {str(error)[:500]}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main())
