"""Run queries in Spark and their SQL in DuckDB and compare row multisets.

    python tests/compare.py [sf] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(records, columns):
    """Rows as a multiset, columns sorted by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in records)


def differences(df, con, sql):
    got = rows_of(df.collect(), df.columns)
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(df.columns):
        return got, None, f"columns {sorted(df.columns)} vs {sorted(names)}"
    want = rows_of(answer.fetchall(), names)
    extra, missing = got - want, want - got
    if extra or missing:
        sample = f"spark {list(extra)[:3]}\n  sql   {list(missing)[:3]}"
        return got, want, f"{sum(extra.values())} / {sum(missing.values())} differ\n  {sample}"
    return got, want, None


def main(argv):
    import __spark_entry__ as spec
    from tidemark import build_session

    sf = argv[1] if len(argv) > 1 else "0.01"
    prefixes = argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = spec.oracle_sql(), []
    for name, run in spec.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                got, _, problem = differences(df, con, oracles[name])
                n = sum(got.values())
            else:
                n, problem = len(df.collect()), None
        except Exception as error:  # report and go on with the next query
            n, problem = 0, f"{type(error).__name__}: {str(error)[:900]}"
        took = time.time() - start
        state = "FAIL" if problem else ("ok" if name in oracles else "ok (rows only)")
        print(f"{state:5} {name:40} {n:7} rows {took:6.2f}s", flush=True)
        if problem:
            print("  " + problem, flush=True)
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
