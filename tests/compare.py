"""Run registered queries on both engines and compare rows, columns and values."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v: object) -> object:
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    got_cols = spark_df.columns
    got = rows_of(got_cols, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = rows_of(want_cols, cur.fetchall())
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    bad = [f"{f.name}: {f.dataType.simpleString()} / {types[f.name]}" for f in spark_df.schema if not same_type(f.dataType.simpleString(), types[f.name])]
    if bad:
        return f"types {bad}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference {sorted(got_cols)}\n  spark {g}\n  sql   {w}"
    return None


SAME = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def same_type(spark_type: str, duck_type: str) -> bool:
    return SAME.get(spark_type) == duck_type


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = connect(sf), e.oracle_sql(), []
    for name, q in e.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        t = time.time()
        try:
            df = q(spark, sf)
            problem = difference(df, con, oracle[name]) if name in oracle else (None if df.count() >= 0 else "no rows")
            n = "" if name in oracle else " (no SQL)"
        except Exception as x:
            problem, n = f"{type(x).__name__}: {str(x)[:1500]}", ""
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - t:.2f}s{n} {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
