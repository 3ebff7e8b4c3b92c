"""Run registered queries and their SQL side by side: python tests/oracle_check.py [sf] [name ...]"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns and the same bag of rows."""
    want = con.execute(sql)
    want_names = [c[0] for c in want.description]
    want_rows = rows_of(want_names, want.fetchall())
    got_names = spark_df.columns
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(set(got_names) ^ set(want_names))}"
    got_rows = rows_of(got_names, spark_df.collect())
    if got_rows == want_rows:
        return None
    extra, lacking = got_rows - want_rows, want_rows - got_rows
    return (
        f"rows {sum(got_rows.values())} vs {sum(want_rows.values())}; "
        f"extra {list(extra)[:1]} lacking {list(lacking)[:1]}"
    )


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_TZ", "UTC"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), e.oracle_sql()
    names = sys.argv[2:] or list(e.queries())
    failed = 0
    for name in names:
        started = time.time()
        try:
            df = e.queries()[name](spark, sf_dir)
            if name in sqls:
                trouble = differences(df, con, sqls[name])
                note = "match" if trouble is None else f"DIFFERS {trouble}"
            else:
                trouble, note = None, f"rows only: {df.count()}"
        except Exception as ex:  # noqa: BLE001
            trouble = note = f"FAILED {type(ex).__name__}: {str(ex)[:600]}"
        failed += trouble is not None
        print(f"{name:28s} {time.time() - started:6.2f}s  {note}", flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
