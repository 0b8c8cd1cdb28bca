"""Run registered queries beside their SQL twins: ``python -m driftlake_checks.compare [folder] [name ...]``."""

from __future__ import annotations

import datetime
import sys
import time

import duckdb

from driftlake_checks.oracles import oracle_sql
from driftlake_checks.queries import GIVEN, REGISTRY
from driftlake.session import build_session


def _norm(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return f"{value:.9g}"
    if value is None:
        return "\0"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_norm(row[i]) for i in order) for row in rows)


def duck(folder):
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def compare(spark, connection, folder, name, sql):
    """``(verdict, spark rows, seconds)``; the verdict is empty when both sides agree."""
    started = time.time()
    df = REGISTRY[name](spark, folder)
    got = df.collect()
    seconds = time.time() - started
    if sql is None:
        return ("" if got else "no rows"), len(got), seconds
    cursor = connection.execute(sql)
    names = [item[0] for item in cursor.description]
    types = {item[0]: str(item[1]) for item in cursor.description}
    want = cursor.fetchall()
    columns, mine = _rows(df.columns, got)
    wanted, theirs = _rows(names, want)
    if columns != wanted:
        return f"columns {columns} / {wanted}", len(mine), seconds
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}", len(mine), seconds
    for left, right in zip(mine, theirs):
        if left != right:
            differing = [(c, l[:80], r[:80]) for c, l, r in zip(columns, left, right) if l != r]
            return f"values {differing}", len(mine), seconds
    mapped = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}
    odd = [(f.name, f.dataType.simpleString(), types[f.name]) for f in df.schema.fields
           if mapped.get(f.dataType.simpleString()) != types[f.name]]
    return (f"types {odd}" if odd else ""), len(mine), seconds


def main(argv):
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, failed = duck(folder), oracle_sql(), 0
    for name in argv[1:] or REGISTRY:
        try:
            verdict, rows, seconds = compare(spark, connection, folder, name, oracles.get(name))
        except Exception as error:  # noqa: BLE001
            verdict, rows, seconds = f"{type(error).__name__}: {str(error)[:600]}", 0, 0.0
        failed += bool(verdict)
        print(f"{'FAIL' if verdict else 'ok  '} {name:45s} {rows:7d} {seconds:6.2f}s"
              f"{' (rows only)' if name not in oracles else ''} {verdict}", flush=True)
    print("unmatched oracles:", sorted(set(oracles) - set(REGISTRY)), "failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
