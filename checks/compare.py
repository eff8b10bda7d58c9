"""Run queries and their SQL side by side: ``python -m checks.compare SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.catalog import QUERIES
from checks.oracle import SQL
from ordergate.session import configure

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _cell(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    f = float(v)
    return "nan" if math.isnan(f) else round(f, 9)


def _rows(rows, order):
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def main() -> int:
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        configure(SparkSession.builder.master("local[8]")).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name in wanted or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            columns = df.columns
            got = _rows(df.collect(), sorted(range(len(columns)), key=columns.__getitem__))
            took = time.time() - started
            if name not in SQL:
                print(f"----  {name}: {sum(got.values())} rows, no SQL, {took:.1f}s", flush=True)
                continue
            started = time.time()
            result = con.execute(SQL[name])
            names = [d[0] for d in result.description]
            want = _rows(result.fetchall(), sorted(range(len(names)), key=names.__getitem__))
            ok = got == want and sorted(names) == sorted(columns) and got
            print(f"{'ok  ' if ok else 'FAIL'}  {name}: {sum(got.values())} rows, {took:.1f}s, sql {time.time() - started:.1f}s",
                  flush=True)
            if not ok:
                bad += 1
                print("   columns", sorted(columns), sorted(names)) if sorted(names) != sorted(columns) else None
                print("   only spark", list((got - want).items())[:3], sum((got - want).values()))
                print("   only sql  ", list((want - got).items())[:3], sum((want - got).values()), flush=True)
        except Exception as error:  # noqa: BLE001 - a report over all queries
            bad += 1
            print(f"FAIL  {name}: {type(error).__name__} {str(error)[:600]}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
