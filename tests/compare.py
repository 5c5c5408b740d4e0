"""Run queries and their SQL side by side and compare all values."""

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, type(v).__name__, v) for v in r))


def differences(df, con, sql):
    """An empty string if the query and the SQL give the same columns, types of value and rows."""
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if not _same(g, w)]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else ""


def _same(g, w):
    return len(g) == len(w) and all(
        type(a) is type(b) and (a == b or (isinstance(a, float) and math.isnan(a) and math.isnan(b)))
        for a, b in zip(g, w))


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sys.path.insert(0, ".")
    from lexforge.queries import ALL

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(ALL)
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    for n in names:
        q = ALL[n]
        t0 = time.time()
        try:
            df = q.run(spark, sf_dir)
            result = differences(df, con, q.sql) if q.sql else f"rows {df.count()}"
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{n:28s} {time.time() - t0:6.1f}s {result or 'same'}", flush=True)
