"""Run registered queries against their SQL in DuckDB: python tests/check_queries.py [sf dir] [names...]"""

import datetime
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    """One text per value: whole numbers exact whatever their type, other numbers as doubles."""
    if isinstance(v, dict):
        return str(sorted((plain(k), plain(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return plain(v.asDict())
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist") and getattr(v, "ndim", 0) > 0:
        return str([plain(x) for x in v])
    if v is None or isinstance(v, (float, Decimal)) and v != v:
        return "<null>"
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        return str(int(v)) if abs(v) != float("inf") and v == int(v) else repr(float(v))
    return str(v)


def canonical(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """Empty text when both sides agree, else what differs."""
    df = query(spark, sf_dir)
    ours = df.collect()
    if sql is None:
        return "" if len(ours) else "no rows"
    result = con.execute(sql)
    columns, theirs = [d[0] for d in result.description], result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    a, b = canonical(ours, df.columns), canonical(theirs, columns)
    if not a:
        return "no rows on our side" if b else "both empty"
    if a == b:
        return ""
    only_a = [r for r in a if r not in set(b)][:2]
    only_b = [r for r in b if r not in set(a)][:2]
    return f"{len(a)} / {len(b)} rows; only ours {only_a}; only SQL {only_b}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    con, sqls = connect(sf), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            problem = compare(session, con, name, query, sqls.get(name), sf)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "sql" if name in sqls else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {kind:4} {time.time() - begin:6.1f}s {name} {problem}", flush=True)
    print("failed:", bad)
