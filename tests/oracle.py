"""Run queries and compare them with their SQL in DuckDB.

    python tests/oracle.py [sf_dir] [query ...]
"""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}


def difference(df, con, sql):
    """None when rows, names and types agree, else what differs."""
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return f"columns {names} / {sorted(rel.columns)}"
    types = dict(zip(rel.columns, map(str, rel.types)))
    ours = {f.name: f.dataType.simpleString() for f in df.schema}
    wrong = {n: (ours[n], types[n]) for n in names if DUCK_TYPES.get(types[n]) != ours[n]}
    if wrong:
        return f"types {wrong}"
    got = sorted(map(repr, (tuple(r) for r in df.select(*names).collect())))
    want = sorted(map(repr, rel.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall()))
    if got != want:
        extra, missing = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        return f"rows {len(got)} / {len(want)}; only ours {extra[:3]}; only theirs {missing[:3]}"
    return None


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from shardlog.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session("oracle")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in argv[1:] or queries():
        t = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            said = difference(df, con, oracle_sql()[name]) if name in oracle_sql() else f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            said = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += said is not None and not said.startswith("rows only")
        print(f"{name:28s} {time.time() - t:6.2f}s {said or 'same'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main(sys.argv[1:])
