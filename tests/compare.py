"""Run registered queries next to their SQL in DuckDB and compare whole results.

    python -m tests.compare [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import collections
import datetime
import decimal
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
DATA = "/root/testdata"


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value) if value != value.to_integral_value() else int(value)
    if isinstance(value, float):
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(canon(v) for v in value)
    return value


KINDS = {
    "int": ("tinyint", "smallint", "int", "bigint", "integer"),
    "float": ("float", "double"),
    "str": ("string", "varchar"),
    "bool": ("boolean",),
}


def kind(type_name):
    """Type family of a Spark or DuckDB type; DECIMAL and HUGEINT have none and must be cast."""
    return next((k for k, names in KINDS.items() if type_name.lower() in names), type_name.lower())


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """(ok, message, spark seconds)"""
    start = time.time()
    df = query(spark, sf_dir)
    got = df.collect()
    took = time.time() - start
    if sql is None:
        return bool(got), f"rows-only {len(got)} rows", took
    rel = con.sql(sql)
    cols = rel.columns
    want = rel.fetchall()
    if sorted(cols) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(cols)}", took
    spark_kinds = {c: kind(t) for c, t in df.dtypes}
    sql_kinds = {c: kind(str(t)) for c, t in zip(cols, rel.types)}
    if spark_kinds != sql_kinds:
        odd = {c: (spark_kinds[c], sql_kinds[c]) for c in cols if spark_kinds[c] != sql_kinds[c]}
        return False, f"types differ (spark, sql): {odd}", took
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a == b:
        return True, f"{len(got)} rows", took
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    key = lambda r: tuple(str(v) for v in r)
    return (
        False,
        f"{len(got)} vs {len(want)} rows; columns {sorted(cols)}; spark only ({len(only_a)}) "
        f"{sorted(only_a, key=key)[:3]}; sql only ({len(only_b)}) {sorted(only_b, key=key)[:3]}",
        took,
    )


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    from riskframe.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"{DATA}/sf{args.sf}"
    spark, con = local_session("compare"), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    picked = [n for n in queries if not args.names or any(n.startswith(a) for a in args.names)]
    failed = 0
    for name in picked:
        try:
            ok, message, took = compare(spark, con, name, queries[name], oracles.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, message, took = False, f"{type(error).__name__}: {str(error)[:1500]}", 0.0
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {took:6.2f}s {message}", flush=True)
    print(f"{len(picked) - failed}/{len(picked)} match")


if __name__ == "__main__":
    main()
