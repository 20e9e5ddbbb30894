"""Side-by-side comparison of a query with its SQL counterpart."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def plain(value: object) -> tuple[str, object]:
    """A value as something that sorts and compares alike whichever engine it came from."""
    if value is None:
        return ("0", "")
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, (int, float)):
        return ("0", "") if isinstance(value, float) and math.isnan(value) else ("n", float(value))
    return ("s", str(value))


def normal(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, sql: str, db: duckdb.DuckDBPyConnection) -> str:
    """Empty if equal, otherwise what differs first."""
    mine = normal(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(sql)
    theirs = normal([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            return f"{str(a)[:600]}\n   !=   {str(b)[:600]}"
    return ""


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    from lantern import build_session

    sf_dir, *wanted = [a for a in sys.argv[1:] if a != "--plain"]
    if "--plain" in sys.argv:
        # a session that knows nothing of this package's settings
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = build_session(
            master="local[8]",
            spark__sql__shuffle__partitions="8",
            spark__ui__enabled="false",
            spark__driver__memory="12g",
        )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    sqls = entry.oracle_sql()
    failed = []
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                problem = compare(df, sqls[name], db)
            else:
                problem = "" if df.count() else "no rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:500]}"
        mark, kind = "FAIL" if problem else "ok  ", "" if name in sqls else "(rows only)"
        print(f"{mark} {name} {time.time() - t:.1f}s {kind} {problem}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
