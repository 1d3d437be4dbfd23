"""Compare every registered query with its SQL at one scale: python tests/compare.py [folder] [names...]"""

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (int, datetime.date, datetime.datetime)):
        return v
    return str(v)


def kind(v):
    return "real" if isinstance(v, (float, decimal.Decimal)) else type(v).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    kinds = {columns[i]: {kind(r[i]) for r in rows if r[i] is not None} for i in order}
    return sorted(columns), sorted(out, key=repr), kinds


def compare(spark, con, folder, name, query, sql):
    """None when equal, else what differs."""
    df = query(spark, folder)
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    right = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if left[2] != right[2]:
        return f"types {[(c, left[2][c], right[2][c]) for c in left[0] if left[2][c] != right[2][c]]}"
    if left[1] != right[1]:
        a, b = set(left[1]), set(right[1])
        return f"rows {len(left[1])} / {len(right[1])}; only here {list(a - b)[:2]}; only SQL {list(b - a)[:2]}"
    return None


if __name__ == "__main__":
    import __spark_entry__  # noqa: F401  functions go to workers by value
    from spanloom.plans.file_queries import FILE_QUERIES
    from spanloom.plans.oracle import ORACLE
    from spanloom.plans.queries import QUERIES
    from spanloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    QUERIES = {**QUERIES, **FILE_QUERIES}
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session("compare", 8, 8), connect(folder)
    for name in names:
        if name not in ORACLE:
            print(f"{name:26s} no SQL")
            continue
        began = time.time()
        try:
            problem = compare(spark, con, folder, name, QUERIES[name], ORACLE[name])
        except Exception as e:  # noqa: BLE001
            problem = f"error {str(e)[:300]}"
        print(f"{name:26s} {time.time() - began:6.1f}s {'ok' if problem is None else 'DIFFERS ' + problem[:700]}", flush=True)
