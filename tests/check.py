"""Run registered queries beside their SQL and compare values strictly.

python tests/check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def in_duckdb(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    names = sorted(spark_df.columns)
    ours = Counter(tuple(plain(r[n]) for n in names) for r in spark_df.collect())
    result = con.execute(sql)
    theirs_names = [c[0] for c in result.description]
    if sorted(theirs_names) != names:
        return False, f"columns differ: {sorted(set(theirs_names) ^ set(names))}"
    order = [theirs_names.index(n) for n in names]
    theirs = Counter(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    if ours == theirs:
        return True, f"{sum(ours.values())} rows"
    extra, missing = list((ours - theirs).elements()), list((theirs - ours).elements())
    hint = ""
    if extra and missing:
        a, b = sorted(extra, key=str)[0], sorted(missing, key=str)[0]
        hint = "; ".join(f"{n}: {x!r} / {y!r}"[:150] for n, x, y in zip(names, a, b) if x != y)
    return False, f"{sum(ours.values())} / {sum(theirs.values())} rows, {len(extra)} differ: {hint}"


def main(sf_dir: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles, con = entry.queries(), entry.oracle_sql(), in_duckdb(sf_dir)
    failed = 0
    for name in names or queries:
        started = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                ok, note = compare(df, con, oracles[name])
            else:
                ok, note = True, f"{df.count()} rows, no SQL"
        except Exception as problem:  # noqa: BLE001
            ok, note = False, f"{type(problem).__name__}: {str(problem)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - started:.1f}s {note}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
