"""Runs a query on Spark and its SQL on DuckDB, and compares rows regardless of their order.

python tests/compare.py [SF_DIR] [NAME ...]
"""

import datetime
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session():
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )


def value(x):
    if isinstance(x, float):
        return float(f"{x:.9g}")
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    if isinstance(x, (list, tuple)):
        return tuple(map(value, x))
    return float(f"{x:.9g}") if type(x).__name__ == "Decimal" else x


def rows(names, tuples) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(value(r[i]) for i in order) for r in tuples)


def duck(sf_dir: str):
    c = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        if p.exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


def compare(spark, name: str, sf_dir: str) -> str:
    """An empty string, or what differs."""
    import __spark_entry__ as e

    df = e.queries()[name](spark, sf_dir)
    ours = rows(df.columns, df.collect())
    sql = e.oracle_sql().get(name)
    if sql is None:
        return ""
    cur = duck(sf_dir).execute(sql)
    cols = [x[0] for x in cur.description]
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(cols)}"
    theirs = rows(cols, cur.fetchall())
    return "" if ours == theirs else f"{ours.total()} rows against {theirs.total()}; {list((ours - theirs).items())[:2]} against {list((theirs - ours).items())[:2]}"[:1500]


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__

    d, *names = sys.argv[1:] or ["/root/testdata/sf0.01"]
    s = session()
    s.sparkContext.setLogLevel("ERROR")
    for n in names or __spark_entry__.queries():
        t = time.time()
        try:
            said = compare(s, n, d) or ("same" if n in __spark_entry__.oracle_sql() else "no SQL")
        except Exception as e:  # reported, and the next one runs
            said = f"{type(e).__name__}: {str(e)[:900]}"
        print(n, said, f"{time.time() - t:.1f} s", flush=True)
