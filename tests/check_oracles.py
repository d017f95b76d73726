"""Run registered queries beside their DuckDB SQL: ``python tests/check_oracles.py DIR [KEY_PREFIX ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def oracle_connection(path: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql: str):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from lodestone.session import build_session

    path, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = oracle_connection(path), oracle_sql(), 0
    for key, query in queries().items():
        if prefixes and not key.startswith(prefixes):
            continue
        started = time.time()
        try:
            columns, rows = spark_rows(query(spark, path))
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"ERROR {key}: {str(error)[:1500]}", flush=True)
            continue
        took = time.time() - started
        if key not in sqls:
            print(f"rows  {key}: {len(rows)} rows in {took:.2f}s", flush=True)
            continue
        try:
            expected = oracle_rows(con, sqls[key])
        except Exception as error:
            bad += 1
            print(f"ORACLE ERROR {key}: {str(error)[:800]}", flush=True)
            continue
        same = (columns, rows) == expected
        bad += not same
        print(f"{'ok   ' if same else 'DIFF '} {key}: {len(rows)} rows in {took:.2f}s", flush=True)
        if not same:
            print("  columns", columns, expected[0])
            only = [r for r in rows if r not in set(expected[1])][:3]
            theirs = [r for r in expected[1] if r not in set(rows)][:3]
            print("  rows", len(rows), len(expected[1]), "\n  spark ", only, "\n  oracle", theirs, flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
